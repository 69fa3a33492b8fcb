from datetime import date

import pytest
from pyspark.sql import functions as F

from leadflow.operators import goals
from leadflow.plans import goals as plans

from .frames import day, rows, tables


def shares(year, **value):
    return [{"year": year, "month": m, **{k: v / 12 for k, v in value.items()}} for m in range(1, 13)]


def test_month_total_is_amount_times_share(spark):
    g = spark.createDataFrame([(2024, 290.0), (2023, 28.0)], "year int, a double")
    s = spark.createDataFrame([(2024, 2, 0.1), (2023, 2, 1.0)], "year int, month int, s double")
    daily = goals.allocate_daily(g, s, {"a": ("a", "s")}, date(2020, 1, 1), date(2024, 12, 31))
    got = {r.year: (r.n, round(r.a, 9), r.d) for r in daily.groupBy(F.year("date").alias("year")).agg(
        F.count("*").alias("n"), F.sum("a").alias("a"), F.max("a").alias("d")).collect()}
    assert got == {2024: (29, 29.0, 1.0), 2023: (28, 28.0, 1.0)}


def test_calendar_cuts_the_goal(spark):
    g = spark.createDataFrame([(2024, 31.0)], "year int, a double")
    s = spark.createDataFrame([(2024, 3, 1.0)], "year int, month int, s double")
    daily = goals.allocate_daily(g, s, {"a": ("a", "s")}, day(29), day(30))
    assert rows(daily, "date", "a") == [(day(30), 1.0)]
    assert goals.allocate_daily(g, s, {"a": ("a", "s")}, date(2025, 1, 1), date(2025, 2, 1)).count() == 0


def test_year_total(spark):
    g = spark.createDataFrame([(2024, "A", 600.0), (2024, "a", 12.0)], "year int, cat string, p double")
    total = goals.even_split_daily(g, {"p": "p"}, date(2023, 1, 1), date(2024, 12, 31), keys=["cat"])
    assert total.count() == 2 * 366
    assert total.agg(F.sum("p")).first()[0] == pytest.approx(612.0)


def test_goal_types(spark):
    """Rate rows and untyped rows are no goals; two goal types multiply the joined production goal."""
    t = tables(spark, yearly_goals=[
        {"year": 2024, "type": "goal", "prod_prod": 366.0 * 2, "crew_goals": 366.0},
        {"year": 2024, "type": "Target", "prod_prod": 366.0, "crew_goals": 366.0},
        {"year": 2024, "type": "WBI_Goal", "prod_prod": 9e9, "crew_goals": 9e9},
        {"year": 2024, "type": None, "prod_prod": 9e9, "crew_goals": 9e9},
    ], monthly_distribution=[{"year": 2024, "month": m, "prod_prod": n / 366}
                             for m, n in zip(range(1, 13), (31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31))])
    day_goal = {r.date: (round(r.prod_goal, 6), round(r.crew_goal, 6)) for r in plans.prod_prod_goal(t, day(1)).collect()}
    assert len(day_goal) == 366 and set(day_goal.values()) == {(6.0, 4.0)}
    plain = plans.prod_prod_goal(t, day(1), fan_out=False).first()
    assert (round(plain.prod_goal, 6), round(plain.crew_goal, 6)) == (3.0, 2.0)
    assert round(plans.crew_weeks_goal(t, day(1)).first().crew_goal, 6) == 2.0


def test_trailing_mean_skips_missing_years(spark):
    data = [(y, 1, float(v)) for y, v in ((2018, 10), (2019, 20), (2021, 30), (2022, 40), (2023, 50))]
    got = goals.trailing_mean(spark.createDataFrame(data, "year int, month int, x double"), ["x"])
    assert rows(got, "year", "x") == [(2018, None), (2019, 10.0), (2021, 15.0), (2022, 20.0), (2023, 30.0)]


def test_seasonal_share_sums_to_hundred(spark):
    data = [(y, m, float(m * y)) for y in (2020, 2021, 2022) for m in range(1, 13)]
    got = goals.seasonal_share(spark.createDataFrame(data, "year int, month int, x double"), ["x"])
    sums = {r.year: r.s for r in got.groupBy("year").agg(F.sum("x").alias("s")).collect()}
    assert sums[2020] is None and sums[2021] == pytest.approx(100) and sums[2022] == pytest.approx(100)


def test_share_of_year_zero_total(spark):
    df = spark.createDataFrame([(2024, 0.0), (2023, 5.0)], "year int, x double")
    assert rows(goals.share_of_year(df, {"pct": "x"}, F.col("year")), "year", "pct") == [(2023, 100.0), (2024, None)]


def test_funnel_chain(spark):
    df = spark.createDataFrame([(100.0,)], "a double")
    rates = spark.createDataFrame([(50.0, 33.3333333)], "x double, y double")
    got = goals.funnel_chain(goals.with_rates(df, rates, {"rx": "x", "ry": "y"}), "a",
                             [("b", "a", "rx"), ("c", "b", "ry"), ("d", "b", "rx")], digits=5)
    assert rows(got, "a", "b", "c", "d") == [(100.0, 50.0, 16.66667, 25.0)]


def test_with_rates_repeats_per_rate_row(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    assert goals.with_rates(df, spark.createDataFrame([(1.0,), (2.0,)], "x double"), {"r": "x"}).count() == 4
    none = spark.createDataFrame([], "x double")
    assert goals.with_rates(df, none, {"r": "x"}).count() == 0


def test_zero_rate_gives_null_leads(spark):
    from leadflow.functions.numbers import ratio
    df = spark.createDataFrame([(5.0, 0.0)], "nd double, r double")
    assert df.select(ratio("nd", F.col("r") / 100)).first()[0] is None
