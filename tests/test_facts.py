from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leadflow.operators.calendar import by_period, calendar, period_filter
from leadflow.operators.facts import Fact, Layout, calendar_left, daily_facts, fact_rows, fact_union, merge_case

from .frames import day, rows

c = F.col


def test_calendar_bounds(spark):
    got = [r.date for r in calendar(spark, day(28, 2), day(2)).collect()]
    assert got == [day(29, 2), day(1), day(2)]
    assert calendar(spark, day(5), day(5)).count() == 0
    assert calendar(spark, day(5), day(1)).count() == 0


def test_calendar_with_data_bound(spark):
    ends = spark.createDataFrame([(day(3),), (day(2),)], "d date").agg(F.max("d")).scalar()
    assert [r.date for r in calendar(spark, day(1), ends).collect()] == [day(2), day(3)]
    none = spark.createDataFrame([(None,)], "d date").agg(F.max("d")).scalar()
    assert calendar(spark, day(1), none).count() == 0
    early = spark.createDataFrame([(day(1),)], "d date").agg(F.max("d")).scalar()
    assert calendar(spark, day(9), early).count() == 0


LAYOUT = Layout({"who": "string"}, {"n": "bigint", "m": "bigint"})


def facts(spark, data):
    df = spark.createDataFrame(data, "d date, e date, who string, n int")
    return fact_rows(df, [
        Fact(c("d"), {"who": c("who")}, {"n": c("n")}),
        Fact(c("e"), {"who": c("who")}, {"m": c("n")}, c("n") > 1),
    ], LAYOUT)


def test_two_facts_from_one_scan(spark):
    df = facts(spark, [(day(1), day(2), "a", 1), (day(1), day(2), "a", 2), (None, None, "b", 3)])
    assert rows(df, "date", "who", "n", "m") == sorted([
        (None, "b", 0, 3), (None, "b", 3, 0), (day(1), "a", 1, 0), (day(1), "a", 2, 0), (day(2), "a", 0, 2)],
        key=lambda r: tuple((v is not None, str(v)) for v in r))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_calendar_left(spark):
    data = [
        (day(1), None, "out", 1),      # on the exclusive start: gone
        (day(2), None, "Ann", 1), (day(2), None, "ANN", 2), (day(2), None, None, 5),
        (day(4), None, "bob", None),   # a fact whose measure is NULL still counts as a fact
        (day(5), None, "out", 1),      # after the end: gone
        (None, None, "out", 1),        # no day: gone
    ]
    df = calendar_left(fact_union([facts(spark, data)], LAYOUT), LAYOUT, day(1), day(4))
    assert rows(df, "date", "who", "n", "m") == [
        (day(2), None, 5, 0), (day(2), "ANN", 3, 0), (day(3), None, None, None), (day(4), "bob", None, 0)]


def test_null_key_and_empty_text_stay_apart(spark):
    df = daily_facts([facts(spark, [(day(2), None, None, 1), (day(2), None, "", 2)])], LAYOUT, (day(1), day(2)))
    assert rows(df, "who", "n") == [(None, 1), ("", 2)]


def test_fill_none_leaves_null(spark):
    layout = Layout({}, {"n": "bigint", "m": "bigint"}, fill=None)
    df = spark.createDataFrame([(day(2), 3)], "d date, n int")
    got = daily_facts([fact_rows(df, [Fact(c("d"), {}, {"n": c("n")})], layout)], layout, (day(1), day(3)))
    assert rows(got, "date", "n", "m") == [(day(2), 3, None), (day(3), None, None)]


def test_conformed_keys_are_not_merged(spark):
    layout = Layout({"who": "string"}, {"n": "bigint", "m": "bigint"}, conformed=("who",))
    df = merge_case(fact_union([facts(spark, [(day(2), None, "a", 1), (day(2), None, "A", 1)])], layout), layout)
    assert df.count() == 2


START = date(2024, 2, 26)
ROW = st.tuples(st.integers(0, 9), st.sampled_from([None, "", "a", "A", "b"]), st.integers(0, 5))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, max_size=25))
def test_calendar_left_against_brute_force(spark, data):
    dated = [(START + timedelta(n), None, who, v) for n, who, v in data]
    after, through = START + timedelta(2), START + timedelta(7)
    got = daily_facts([facts(spark, dated)], LAYOUT, (after, through)) if dated else None
    expected = {}
    for d, _, who, v in dated:
        if after < d <= through:
            key = (d, None if who is None else who.lower())
            spelling, total = expected.get(key, (who, 0))
            expected[key] = (min(spelling, who) if who is not None else None, total + v)
    want = [(d, spelling, total) for (d, _), (spelling, total) in expected.items()]
    for n in range(3, 8):
        d = START + timedelta(n)
        if d not in {k[0] for k in expected}:
            want.append((d, None, None))
    if got is not None:
        assert rows(got, "date", "who", "n") == sorted(want, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_periods(spark):
    as_of = day(13)  # a Wednesday
    days = [as_of - timedelta(n) for n in range(400)]
    df = spark.createDataFrame([(d, 1) for d in days], "d date, n int")
    got = {r.period: r.n for r in by_period(df, "d", as_of, ["n"]).collect()}
    assert got == {"R12": 366, "YTD": 73, "today": 1, "yesterday": 1, "last_week_to_date": 3,
                   "this_week_to_date": 3, "R4W": 28}
    for period, n in got.items():
        assert period_filter(df, "d", period, as_of).count() == n
