"""Loads in batches: marks, guarded pointers, side tables, folds, kept sums and touches."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from leadflow.functions.numbers import COUNT, MONEY
from leadflow.operators import attribution, deltas
from leadflow.operators.facts import Fact, Layout, daily_facts, fact_rows, fact_union
from leadflow.plans import pipeline
from leadflow.session import scratch_path
from leadflow.sources import batches, files, load, sheets, sinks
from leadflow.sources.batches import BATCH
from leadflow.streaming import upserts

from .frames import day, rows

# -- marks and pointers --------------------------------------------------------

ORDERS = "id int, t string, at timestamp_ntz"


def pulls(spark, root, monkeypatch=None, partition=None):
    """Run ingest over a growing source; gives the run function and the rows pulled by each run."""
    obj = pipeline.RawObject("o", ("id",), ("at",), "at", timedelta(hours=12), *(("day", "to_date(at)") if partition else ()))
    seen = []

    def run(n, data, fail=False):
        spark.createDataFrame(data, ORDERS).write.mode("overwrite").parquet(f"{root}/src{n}")
        it = pipeline.Run(spark, root, f"r{n}", prefix=f"p{root[-8:]}_")

        def changed(change):
            seen.append(sorted(r.id for r in change.new.collect()))
            if fail:
                raise RuntimeError("stopped before the pointer")
        pipeline.ingest(it, {"o": load.Source("parquet", f"{root}/src{n}")}, [obj], changed)
        return it
    return run, seen


A, B, C = datetime(2024, 3, 1), datetime(2024, 3, 2), datetime(2024, 3, 3)


def test_a_second_process_pulls_only_what_is_new(spark):
    root = scratch_path(spark, "mark")
    run, seen = pulls(spark, root, partition=True)
    run(1, [(1, "a", A), (2, "b", B)])
    assert pipeline.Run(spark.newSession(), root, "x").current("o").mark == load.Mark("2024-03-02T00:00:00.000000", "2")
    late = (4, "late", B - timedelta(hours=3))
    it = run(2, [(1, "a", A), (2, "b", B), (3, "c", C), late])
    assert seen == [[1, 2], [3, 4]]
    assert rows(it.old("o"), "id", "t") == [(1, "a"), (2, "b"), (3, "c"), (4, "late")]
    it = run(3, [(1, "a", A), (2, "b", B), (3, "c", C), late])
    assert len(seen) == 2 and it.current("o").number == 2


def test_a_failed_run_does_not_move_the_mark(spark):
    root = scratch_path(spark, "fail")
    run, seen = pulls(spark, root, partition=True)
    run(1, [(1, "a", A)])
    with pytest.raises(RuntimeError):
        run(2, [(1, "A", B), (2, "b", B)], fail=True)
    before = pipeline.Run(spark, root, "y").current("o")
    assert before.number == 1 and before.mark.at.startswith("2024-03-01")
    it = run(3, [(1, "A", B), (2, "b", B), (3, "c", C)])  # goes on with what run 2 had pulled
    assert seen == [[1], [1, 2], [1, 2]] and it.current("o").mark.at.startswith("2024-03-02")
    run(4, [(1, "A", B), (2, "b", B), (3, "c", C)])
    assert seen[-1] == [3] and rows(it.old("o"), "id", "t") == [(1, "A"), (2, "b"), (3, "c")]


def test_append_without_key_takes_each_row_once(spark):
    root = scratch_path(spark, "append")
    obj = pipeline.RawObject("log", None, ("at",), "at")
    for n, data in enumerate([[(1, "a", A), (1, "a", A)], [(1, "a", A), (1, "a", A), (1, "a", A), (2, "b", B)]], 1):
        spark.createDataFrame(data, ORDERS).write.parquet(f"{root}/src{n}")
        run = pipeline.Run(spark, root, f"r{n}", prefix="append_")
        pipeline.ingest(run, {"log": load.Source("parquet", f"{root}/src{n}")}, [obj])
    assert rows(run.old("log"), "id", "t") == [(1, "a"), (1, "a"), (1, "a"), (2, "b")]


def test_marks_without_times(spark):
    none = spark.createDataFrame([(1, "a", None)], ORDERS)
    assert load.next_mark(none, "at", ["id"], None) is None
    old = load.Mark("2024-03-02T00:00:00.000000", "7")
    assert load.next_mark(none, "at", ["id"], old) == old
    assert load.next_mark(spark.createDataFrame([(9, "a", A)], ORDERS), "at", ["id"], old) == old  # it never goes back
    assert load.pull_after(none, "at", old).count() == 1


def test_two_writers_cannot_publish_one_number(spark):
    root = scratch_path(spark, "two")
    one = spark.createDataFrame([(1,)], "id int")
    first, second = pipeline.Run(spark, root, "a", "two_"), pipeline.Run(spark, root, "b", "two_")
    first.publish("t", one)
    number = second.next_number("t")
    first.point("t", number, f"{root}/a/t")
    with pytest.raises(files.Taken):
        second.point("t", number, f"{root}/b/t")
    assert second.current("t").folder == f"{root}/a/t"
    second.publish("t", one.union(one))  # called again, it takes the next number
    assert second.current("t").number == 3 and second.old("t").count() == 2


def test_an_empty_pointer_of_a_died_writer_is_passed_over(spark):
    root = scratch_path(spark, "died")
    run = pipeline.Run(spark, root, "a", "died_")
    run.publish("t", spark.createDataFrame([(1,)], "id int"))
    fs, where = files._at(spark, f"{root}/_current/t/2")
    fs.create(where, False).close()
    assert run.current("t").number == 1 and run.next_number("t") == 3
    pipeline.Run(spark, root, "b", "died_").publish("t", spark.createDataFrame([(1,), (2,)], "id int"))
    assert run.old("t").count() == 2


def test_old_folders_go(spark):
    root = scratch_path(spark, "old")
    for n in range(4):
        run = pipeline.Run(spark, root, f"r{n}", "old_")
        run.publish("t", spark.createDataFrame([(n,)], "id int"))
    run.clean("t", keep=2)
    assert [files.exists(spark, f"{root}/r{n}/t") for n in range(4)] == [False, False, True, True]
    assert rows(run.old("t"), "id") == [(3,)] and run.next_number("t") == 5


def test_goals_stay_when_their_year_leaves_the_sheet(spark):
    run = pipeline.Run(spark, scratch_path(spark, "goals"), "r1", "goals_")
    months = ", ".join(f"m{m} string" for m in range(1, 13))
    sheet = lambda *years: spark.createDataFrame([(str(y), v, *[None] * 11) for y, v in years], f"year string, {months}")
    run2 = pipeline.Run(spark, run.root, "r2", "goals_")
    pipeline.load_goals(run, {"d": sheets.monthly_goals({"value": sheet((2023, "1"), (2024, "2")), "prod": sheet((2024, "5"))})})
    pipeline.load_goals(run2, {"d": sheets.monthly_goals({"value": sheet((2024, "3"), (2025, "4")), "prod": sheet((2024, ""))})})
    assert rows(run2.old("d"), "year", "month", "value", "prod") == [
        (2023, 1, 1.0, None), (2024, 1, 3.0, 5.0), (2025, 1, 4.0, None)]


def test_stage_reads_what_was_published(spark):
    run = pipeline.Run(spark, scratch_path(spark, "pub"), "r1", "pub_")
    run.publish("lead", spark.createDataFrame([("new",)], "id string"))
    others = lambda role, *columns: spark.createDataFrame([("old",)], "id string")
    tables = pipeline.PublishedTables(run, others)
    assert tables("lead", "id").first().id == "new" and tables("sale", "id").first().id == "old"


# -- which partition holds a key -------------------------------------------------

KEYED = "id int, t string, month string, seq int"


def keyed(spark, root, data):
    spark.createDataFrame(data, KEYED).drop("seq").repartition("month").write.partitionBy("month").parquet(f"{root}/t")


def upsert(spark, root, n, data):
    batch = spark.createDataFrame(data, KEYED)
    return sinks.upsert_partitions(spark, f"{root}/t", f"{root}/staged{n}", batch, ["id"], ["seq"], "month", f"{root}/places", n)


def test_side_table_finds_moved_keys(spark):
    root = scratch_path(spark, "places")
    keyed(spark, root, [(1, "a", "01", 0), (2, "b", "01", 0), (3, "c", "02", 0), (4, "d", None, 0), (5, "e", "03", 0), (None, "n", "01", 0)])
    got = upsert(spark, root, 1, [(1, "A", "02", 1), (4, "D", "04", 1), (5, "E", None, 1)])
    assert sorted(map(str, rows(got, "id", "t", "month"))) == sorted(map(str, [
        (1, "A", "02"), (2, "b", "01"), (3, "c", "02"), (4, "D", "04"), (5, "E", None), (None, "n", "01")]))
    got = upsert(spark, root, 2, [(1, "AA", "05", 2), (5, "EE", "01", 2), (4, "x", "09", 0), (4, "y", "04", 3), (None, "m", "01", 2)])
    sinks.fold_places(spark, f"{root}/places", ["id"], "month", fan=2)
    got = upsert(spark, root, 3, [(2, "B", "01", 3), (3, "C", "05", 3)])
    assert sorted(map(str, rows(got, "id", "t", "month"))) == sorted(map(str, [
        (1, "AA", "05"), (2, "B", "01"), (3, "C", "05"), (4, "y", "04"), (5, "EE", "01"), (None, "n", "01"), (None, "m", "01")]))


def test_only_the_batchs_buckets_and_partitions_are_read(spark):
    root = scratch_path(spark, "buckets")
    keyed(spark, root, [(i, "a", f"{i % 12:02}", 0) for i in range(2000)])
    sinks.start_places(spark.read.schema("id int, t string, month string").parquet(f"{root}/t"), f"{root}/places", ["id"], "month")
    keys = spark.createDataFrame([(7,), (19,)], "id int")
    held = sinks._held(spark, f"{root}/places", keys, ["id"], "month")
    assert rows(held, "month") == [("07",), ("07",)]
    buckets = {r[0] for r in keys.select(sinks._bucket(["id"])).collect()}
    scans = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [key_bucket" in scans and f"{root}/t" not in scans
    read = spark.read.parquet(f"{root}/places/batch=0").where(F.col("key_bucket").isin(list(buckets)))
    assert {f.split("key_bucket=")[1].split("/")[0] for f in read.inputFiles()} >= {str(b) for b in buckets}
    before = {f for f in spark.read.parquet(f"{root}/t").inputFiles() if "month=07" not in f}
    got = upsert(spark, root, 1, [(7, "A", "07", 1)])
    assert before <= set(got.inputFiles())  # the other months' files are those of before


def test_staging_tells_old_and_new_rows(spark):
    root = scratch_path(spark, "oldnew")
    keyed(spark, root, [(1, "a", "01", 0), (2, "b", "01", 0)])
    upsert(spark, root, 1, [(1, "A", "02", 1), (3, "c", "02", 1)])
    assert rows(spark.read.parquet(sinks.old_rows(f"{root}/staged1")), "id", "t", "month") == [(1, "a", "01")]
    assert rows(spark.read.parquet(sinks.new_rows(f"{root}/staged1")), "id", "t", "month") == [(1, "A", "02"), (3, "c", "02")]


def test_upsert_keeps_the_order_of_columns(spark):
    target = spark.createDataFrame([("x", 1, 2)], "t string, a int, b int")
    assert sinks.upsert_by_key(target, target, ["b", "a"], ["t"]).columns == ["t", "a", "b"]


# -- folds ---------------------------------------------------------------------------

def test_tiers(spark):
    folder = scratch_path(spark, "tiers")
    add = lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n"))
    expected, seen = Counter(), []
    for n in range(11):
        batches.write_batch(folder, n, spark.createDataFrame([(n % 3, 1), (9, n)], "k int, n int"))
        expected[n % 3] += 1
        expected[9] += n
        batches.fold(spark, folder, add, fan=3)
        seen.append([(s.first, s.last) for s in batches.live(spark, folder)])
        assert dict(rows(add(batches.read(spark, folder)), "k", "n")) == expected
    assert seen[7] == [(0, 2), (3, 5), (6, 6), (7, 7)] and seen[8] == [(0, 8)] and seen[10] == [(0, 8), (9, 9), (10, 10)]
    assert files.names(spark, folder) == ["batch=10", "batch=9", "folded=0-8"]
    batches.write_batch(folder, 4, spark.createDataFrame([(0, 99)], "k int, n int"))  # folded long ago
    assert dict(rows(add(batches.read(spark, folder)), "k", "n")) == expected
    assert batches.last_batch(spark, folder) == 10 and batches.read(spark, f"{folder}/none") is None


def test_unfinished_folders_do_not_count(spark):
    folder = scratch_path(spark, "unfinished")
    one = spark.createDataFrame([(1, 1)], "k int, n int")
    for n in range(2):
        batches.write_batch(folder, n, one)
    one.write.parquet(f"{folder}/folded=0-1")
    files.remove(spark, f"{folder}/folded=0-1/_SUCCESS")
    assert [s.path[-7:] for s in batches.live(spark, folder)] == ["batch=0", "batch=1"]
    batches.fold(spark, folder, lambda r: r.groupBy("k").agg(F.sum("n").alias("n")), fan=2, clean_up=False)
    assert rows(batches.read(spark, folder), "k", "n", BATCH) == [(1, 2, 1)]
    assert files.names(spark, folder) == ["batch=0", "batch=1", "folded=0-1"]
    batches.clean(spark, folder)
    assert files.names(spark, folder) == ["folded=0-1"]


def test_ties_go_to_the_later_batch_before_and_after_folding(spark):
    folder = scratch_path(spark, "ties")
    for n, text in enumerate("abc"):
        batches.write_batch(folder, n, spark.createDataFrame([(1, text, 5), (2, text, 9 - n)], "id int, t string, seq int"))
    current = lambda: rows(upserts.current_rows(spark, folder, ["id"], ["seq"]), "id", "t")
    assert current() == [(1, "c"), (2, "a")]
    upserts.fold(spark, folder, ["id"], ["seq"], fan=2)
    assert current() == [(1, "c"), (2, "a")]
    base = spark.createDataFrame([(1, "base", 5), (3, "base", 0)], "id int, t string, seq int")
    assert rows(upserts.current_rows(spark, folder, ["id"], ["seq"], base), "id", "t") == [(1, "c"), (2, "a"), (3, "base")]


# -- kept sums ----------------------------------------------------------------------

LAYOUT = Layout({"who": "string"}, {"n": COUNT, "money": MONEY}, fill=None)
SALES = "id int, sold date, paid date, who string, amount decimal(18,4)"


def facts_of(df):
    return [fact_rows(df, [Fact(F.col("sold"), {"who": F.col("who")}, {"n": F.lit(1)}),
                           Fact(F.col("paid"), {"who": F.col("who")}, {"money": F.col("amount")}, F.col("who") != "out")], LAYOUT)]


def test_kept_sums_equal_a_full_sum(spark):
    rng, folder = random.Random(4), scratch_path(spark, "sums")
    pick = lambda xs: rng.choice(xs)
    make = lambda i: (i, pick([day(1), day(2), day(3), None]), pick([day(2), day(4), None]), pick(["a", "A", "out", None, "é"]),
                      pick([None, 0, 1, 25, -3]))
    frame = lambda data: spark.createDataFrame(data, "id int, sold date, paid date, who string, amount int").withColumn(
        "amount", F.col("amount").cast(MONEY))
    kept = deltas.KeptSums(spark, folder, LAYOUT)
    state = {i: make(i) for i in range(60)}
    kept.refresh(0, [], facts_of(frame(list(state.values()))))
    for n in range(1, 6):
        changed = {i: make(i) for i in rng.sample(range(80), 25)}
        old = [state[i] for i in changed if i in state]
        new = frame(list(changed.values()))
        for _ in range(2):  # a refresh that is repeated changes nothing
            kept.refresh(n, facts_of(frame(old)) if old else [], facts_of(new))
        state.update(changed)
        full = fact_union(facts_of(frame(list(state.values()))), LAYOUT).where("date is not null")
        assert rows(kept.sums(), "date", "who", "n", "money") == rows(full, "date", "who", "n", "money")
        kept.fold(fan=2)
        assert rows(kept.sums(F.col("date") > day(2)), "date", "who", "n") == rows(full.where(F.col("date") > F.lit(day(2))), "date", "who", "n")
    kept.refresh(9, facts_of(frame(list(state.values()))), [])
    kept.fold(whole=True)
    assert kept.sums().count() == 0 and len(batches.live(spark, folder)) == 1
    span = (day(1), day(6))
    assert daily_facts([kept.sums()], LAYOUT, span).count() == 5


def test_only_changed_groups_are_written(spark):
    folder = scratch_path(spark, "touched")
    kept = deltas.KeptSums(spark, folder, LAYOUT)
    sale = lambda *r: spark.createDataFrame([r], SALES)
    many = spark.range(1000).select(F.col("id").cast("int"), F.lit(day(1)).alias("sold"), F.lit(day(2)).alias("paid"),
                                    F.concat(F.lit("p"), F.col("id") % 100).alias("who"), F.lit(1).cast(MONEY).alias("amount"))
    kept.refresh(0, [], facts_of(many))
    from decimal import Decimal
    kept.refresh(1, facts_of(sale(3, day(1), day(2), "p3", Decimal(1))), facts_of(sale(3, day(1), day(2), "p3", Decimal(7))))
    assert spark.read.parquet(f"{folder}/batch=1").count() == 1  # the count of that day and person is as it was
    assert spark.read.parquet(f"{folder}/batch=0").count() == 200


def test_sums_of_doubles_are_refused(spark):
    layout = Layout({}, {"x": "double"})
    with pytest.raises(ValueError):
        deltas.difference([], [spark.createDataFrame([(date(2024, 1, 1), 1.0)], "date date, x double")], layout)


def test_a_run_keeps_its_kpis(spark):
    """Three runs over growing sources: the KPI from kept sums is that of the published tables, also after a failed run."""
    from leadflow.plans import kept, sales
    from star_roles import AS_OF, CALENDAR_AFTER, StarRoles

    root, star = scratch_path(spark, "kpis"), StarRoles(spark, "/root/testdata/sf0.001")
    sale = star("sale").withColumn("changed_on", F.lit(A))
    visit = star("appointment").withColumn("changed_on", F.lit(A))
    tenth = F.split_part("id", F.lit("-"), F.lit(1)).cast("bigint") % 10
    later = [sale, sale.where(tenth != 1).unionByName(sale.where(tenth == 1).withColumns({
        "sold_on": F.date_add("sold_on", 400), "total_sales": (F.col("total_sales") + 5).cast(MONEY), "changed_on": F.lit(B)}))]
    later.append(later[1].where(tenth != 2).unionByName(sale.where(tenth == 2).withColumns({
        "department": F.lit("Service"), "changed_on": F.lit(C)})))
    objects = [pipeline.RawObject(n, ("id",), ("changed_on",), "changed_on", timedelta(hours=1), "year", f"date_format({d}, 'yyyy')")
               for n, d in (("sale", "sold_on"), ("appointment", "start_on"))]
    kpis = kept.KeptKpis(spark, root)
    visit.write.parquet(f"{root}/visit")
    for n, state in enumerate(later):
        state.write.parquet(f"{root}/sale{n}")
        manifest = {"sale": load.Source("parquet", f"{root}/sale{n}"), "appointment": load.Source("parquet", f"{root}/visit")}

        def fails(change):
            kpis.on_change(change)
            raise RuntimeError("after the sums, before the pointer")
        if n == 1:
            with pytest.raises(RuntimeError):
                pipeline.ingest(pipeline.Run(spark, root, "bad", "kpi_"), manifest, objects, fails)
        run = pipeline.Run(spark, root, f"r{n}", "kpi_")
        pipeline.ingest(run, manifest, objects, kpis.on_change)
        full = sales.ads_adl(pipeline.PublishedTables(run, star), AS_OF, CALENDAR_AFTER)
        shown = [sorted((str(r.date), r.adl and round(r.adl, 6), r.ads and round(r.ads, 6)) for r in df.collect())
                 for df in (kpis.ads_adl(AS_OF, CALENDAR_AFTER), full)]
        assert shown[0] == shown[1] and any(r[1] for r in shown[0])
    assert batches.last_batch(spark, f"{root}/_sums/ads_adl/appointment") == 1  # it has not changed since


# -- kept first touches -----------------------------------------------------------------

APPOINTMENTS = "id string, lead_id string, set_on string, set_by string"


def test_kept_touches_equal_full_first_touch(spark):
    rng, folder = random.Random(8), scratch_path(spark, "touch")
    make = lambda i: (str(i), rng.choice(["L1", "l1", "L2", "L3", "é", "É", None]), rng.choice(["2024-01-0" + str(d) for d in range(1, 9)] + [None]),
                      rng.choice(["x", "y", None]))
    kept = deltas.KeptTouches(spark, folder)
    state = {str(i): make(i) for i in range(12)}
    frame = lambda data: spark.createDataFrame(list(data), APPOINTMENTS)
    kept.refresh(0, None, frame(state.values()))
    for n in range(1, 8):
        changed = {str(i): make(i) for i in rng.sample(range(20), 6)}
        old = [state[i] for i in changed if i in state]
        state.update(changed)
        for _ in range(2):
            kept.refresh(n, frame(old), frame(changed.values()), frame(state.values()))
        full = attribution.first_touch(frame(state.values()))
        assert rows(kept.touches(), "lead_id", "set_by") == rows(full, "lead_id", "set_by")
        kept.fold(fan=3)
        assert rows(kept.touches(), "lead_id", "set_by") == rows(full, "lead_id", "set_by")


# -- sheets ------------------------------------------------------------------------------

def test_a_sheet_ends_at_its_first_row_without_a_year(spark):
    root = scratch_path(spark, "gap")
    months = [f"m{m}" for m in range(1, 13)]
    lines = ["year," + ",".join(months), "2023,1" + "," * 11, "2024,2" + "," * 11, "Total,9" + "," * 11, "2025,3" + "," * 11]
    spark.createDataFrame([("\n".join(lines),)], "v string").coalesce(1).write.text(f"{root}/csv")
    sheet = sheets.sheet_rows(spark, f"{root}/csv")
    assert rows(sheets.unpivot_months(sheet, "v"), "year", "v") == [(2023, 1.0), (2024, 2.0)]
    spark.read.option("header", True).csv(f"{root}/csv").write.parquet(f"{root}/parquet")
    sheet = sheets.sheet_rows(spark, f"{root}/parquet", "parquet")
    assert rows(sheets.unpivot_months(sheet, "v"), "year", "v") == [(2023, 1.0), (2024, 2.0)]
    assert sheets.until_gap(sheet.where("year <> 'Total'")).count() == 3
    header = spark.createDataFrame([("m1", "Basement", "")], "col_id string, category string, name string")
    goals = sheets.unpivot_goal_headers(sheet.select("year", "m1", "row"), header, "sold")
    assert rows(goals, "year", "sold") == [("2023", 1.0), ("2024", 2.0)]
