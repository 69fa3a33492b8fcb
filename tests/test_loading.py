from datetime import datetime

import pytest
from pyspark.sql import functions as F

from leadflow.sources import load, sheets, sinks
from leadflow.session import scratch_path

from .frames import day, rows

TARGET = [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0), (None, "n", 0.0)]
BATCH = [(2, "first", 5.0, 1), (2, None, 6.0, 2), (4, "new", 7.0, 1), (None, "m", 9.0, 1), (None, "k", 9.0, 1)]


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame(TARGET, "id int, t string, v double")


@pytest.fixture(scope="module")
def batch(spark):
    return spark.createDataFrame(BATCH, "id int, t string, v double, seq int")


AFTER = [(None, "k", 9.0), (None, "m", 9.0), (None, "n", 0.0), (1, "a", 1.0), (2, None, 6.0), (3, "c", 3.0), (4, "new", 7.0)]


def test_upsert(spark, target, batch):
    assert rows(sinks.upsert_by_key(target, batch, ["id"], ["seq"]), "id", "t", "v") == AFTER


def test_upsert_is_idempotent_on_keyed_rows(target, batch):
    keyed = batch.where("id is not null")
    once = sinks.upsert_by_key(target, keyed, ["id"], ["seq"])
    twice = sinks.upsert_by_key(once, keyed, ["id"], ["seq"])
    assert rows(once, "id", "t", "v") == rows(twice, "id", "t", "v")


def test_upsert_empty_batch_and_append(target, batch):
    assert sinks.upsert_by_key(target, batch.limit(0), ["id"], ["seq"]).count() == 4
    assert sinks.upsert_by_key(target, batch, None, ["seq"]).count() == 9


def test_insert_ignore(target, batch):
    got = sinks.insert_ignore(batch.where("id is not null"), ["id"], ["seq"], target)
    assert rows(got, "id", "t") == [(None, "n"), (1, "a"), (2, "b"), (3, "c"), (4, "new")]
    assert rows(sinks.insert_ignore(batch.where("id is not null"), ["id"], ["seq"]), "id", "t") == [(2, "first"), (4, "new")]


def test_upsert_column(spark, target):
    fresh = spark.createDataFrame([(2, 9.0), (5, 8.0), (3, None)], "id int, v double")
    got = sinks.upsert_column(target.where("id is not null"), fresh, ["id"], "v")
    assert rows(got, "id", "t", "v") == [(1, "a", 1.0), (2, "b", 9.0), (3, "c", 3.0), (5, None, 8.0)]


def test_update_if_changed(spark):
    old = spark.createDataFrame([(1, 5), (2, None), (3, 7), (4, 8)], "k int, v int")
    new = spark.createDataFrame([(1, 5), (2, None), (3, None), (9, None)], "k int, v int")
    got = sinks.update_if_changed(old, new, ["k"], "v")
    assert rows(got, "k", "v", "action") == [
        (1, 5, "none"), (2, None, "none"), (3, None, "update"), (4, 8, "none"), (9, None, "insert")]


def test_snapshot_replace_keeps_old_if_empty(spark, target):
    root = scratch_path(spark, "snap")
    sinks.snapshot_replace(spark, target, "snap_view", f"{root}/1")
    assert sinks.snapshot_replace(spark, target.where("id = 1"), "snap_view", f"{root}/2").count() == 1
    assert sinks.snapshot_replace(spark, target.where("id = 77"), "snap_view", f"{root}/3").count() == 1
    kept = sinks.snapshot_replace(spark, target.where("id = 77"), "snap_view", f"{root}/4", keep_old_if_empty=False)
    assert kept.count() == 0


def test_snapshot_may_read_the_view_it_replaces(spark, target):
    root = scratch_path(spark, "self")
    sinks.snapshot_replace(spark, target, "self_view", f"{root}/1")
    more = spark.table("self_view").unionByName(spark.table("self_view"))
    assert sinks.snapshot_replace(spark, more, "self_view", f"{root}/2").count() == 8


def test_upsert_partitions_leaves_others_alone(spark):
    root = scratch_path(spark, "parts")
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 2)], "id int, t string, month int")
    old.write.partitionBy("month").parquet(f"{root}/t")
    files = lambda df: {r[0] for r in df.where("month = 2").select(F.input_file_name()).collect()}
    untouched = files(spark.read.parquet(f"{root}/t"))
    batch = spark.createDataFrame([(2, "B", 1, 1), (9, "z", 3, 1)], "id int, t string, month int, seq int")
    got = sinks.upsert_partitions(spark, f"{root}/t", f"{root}/staging", batch, ["id"], ["seq"], "month")
    assert rows(got, "id", "t", "month") == [(1, "a", 1), (2, "B", 1), (3, "c", 2), (9, "z", 3)]
    assert files(got) == untouched


def test_stage_cast(spark):
    df = spark.createDataFrame([("2024-03-01", "x", "3.5"), ("bad", None, "n/a")], "d string, q string, s string")
    got = sinks.stage_cast(df, [("date", "d", "date"), ("quote", "q", "string"), ("sold", "s", "double")])
    assert rows(got, "date", "quote", "sold") == [(None, None, None), (day(1), "x", 3.5)]


def test_load_object_and_types(spark):
    path = scratch_path(spark, "json")
    spark.createDataFrame([(1, 2.5, True, "2024-01-01T00:00:00")], "Id int, x float, ok boolean, at string").select(
        "*", F.struct(F.lit("Lead").alias("type")).alias("attributes"), F.array(F.lit(1)).alias("l")).write.json(path)
    loaded = load.load_object(spark, {"lead": load.Source("json", path)}, "lead")
    assert "attributes" not in loaded.columns
    assert dict(load.conform_types(loaded).dtypes) == {
        "Id": "bigint", "x": "double", "ok": "boolean", "at": "string", "l": "string"}


def test_csv_source(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([(1, "a")], "id int, t string").write.option("header", True).csv(path)
    source = load.Source("csv", path, {"header": "true"}, "id int, t string")
    assert rows(load.load_object(spark, {"x": source}, "x"), "id", "t") == [(1, "a")]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.5), (3, None)], "id int, v double")
    assert rows(load.nan_to_null(df), "id", "v") == [(1, None), (2, 1.5), (3, None)]


def test_incremental(spark):
    df = spark.createDataFrame([(1, datetime(2024, 3, 1)), (2, datetime(2024, 3, 2))], "id int, at timestamp")
    assert rows(load.incremental_pull(df, "at", datetime(2024, 3, 2)), "id") == [(2,)]
    assert load.high_water_mark(df, "at").first().mark == datetime(2024, 3, 2)


def test_unpivot_months(spark):
    columns = "year string, " + ", ".join(f"m{m} string" for m in range(1, 13))
    blank = [None] * 9
    df = spark.createDataFrame([
        ("2024", "0", "", "0.12345678912", *blank), ("Total", "1", "1", "1", *blank), ("2026", "5", None, "x", *blank)], columns)
    assert rows(sheets.unpivot_months(df, "value"), "year", "month", "value") == [
        (2024, 1, 0.0), (2024, 3, 0.1234567891), (2026, 1, 5.0)]


def test_goal_headers(spark):
    wide = spark.createDataFrame([(2024, "1", "2", "3"), (2025, "", None, "4")], "year int, c1 string, c2 string, c3 string")
    header = spark.createDataFrame([("c1", "Basement", "Ann"), ("c2", "Basement", ""), ("c3", None, "Bob")],
                                   "col_id string, category string, name string")
    got = sheets.unpivot_goal_headers(wide, header, "sold")
    assert rows(got, "year", "product_category", "name", "sold") == [
        (2024, "Basement", None, 2.0), (2024, "Basement", "Ann", 1.0)]
    net = sheets.unpivot_goal_headers(wide.where("year = 2024"), header, "net")
    both = sheets.merge_goal_metrics({"sold": got, "net": net}, named=True)
    assert rows(both, "year", "name", "sold", "net") == [(2024, "Ann", 1.0, 1.0)]


def test_merge_shares(spark):
    a = spark.createDataFrame([(2024, 1, 0.5)], "year int, month int, a double")
    b = spark.createDataFrame([(2024, 1, 0.25), (2024, 2, 1.0)], "year int, month int, b double")
    assert rows(sheets.merge_share_columns({"a": a, "b": b}), "year", "month", "a", "b") == [
        (2024, 1, 0.5, 0.25), (2024, 2, None, 1.0)]


def test_pairs_and_cells(spark):
    df = spark.createDataFrame([("t", "e"), ("t", "e"), ("t", ""), (None, "e"), (None, None)], "team string, employee string")
    assert rows(sheets.load_pairs(df, "team", "employee"), "team", "employee") == [("t", "e")]
    cells = sheets.kpi_cells(spark.createDataFrame([("0.123456789012", None)], "a string, b string"), ["a", "b"], datetime(2024, 3, 1))
    assert rows(cells, "a", "b", "created") == [(0.123456789, None, datetime(2024, 3, 1))]


def _parts(spark, old, batch):
    root = scratch_path(spark, "parts")
    spark.createDataFrame(old, "id int, t string, month int").write.partitionBy("month").parquet(f"{root}/t")
    new = spark.createDataFrame(batch, "id int, t string, month int, seq int")
    got = sinks.upsert_partitions(spark, f"{root}/t", f"{root}/staging", new, ["id"], ["seq"], "month")
    return root, new, sorted((tuple(r) for r in got.select("id", "t", "month").collect()), key=str)


def test_upsert_partitions_keeps_the_null_partition(spark):
    _, _, got = _parts(spark, [(1, "a", None), (2, "b", None), (3, "c", 1)], [(2, "B", None, 1), (4, "d", None, 1)])
    assert got == [(1, "a", None), (2, "B", None), (3, "c", 1), (4, "d", None)]


def test_upsert_partitions_moves_keys(spark):
    """A key leaves its old partition, also when nothing else is left there."""
    _, _, got = _parts(spark, [(1, "a", 1), (2, "b", 1), (3, "c", 2)], [(1, "A", 5, 1), (3, "C", None, 1), (3, "x", 2, 0)])
    assert got == [(1, "A", 5), (2, "b", 1), (3, "C", None)]


def test_upsert_partitions_goes_on_from_staging(spark):
    root, new, got = _parts(spark, [(1, "a", 1), (3, "c", 2)], [(1, "A", 2, 1)])
    again = sinks.upsert_partitions(spark, f"{root}/t", f"{root}/staging", new, ["id"], ["seq"], "month")
    assert rows(again, "id", "t", "month") == got == [(1, "A", 2), (3, "c", 2)]
