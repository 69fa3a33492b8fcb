from datetime import datetime, timedelta

from pyspark.sql import functions as F

from leadflow.session import scratch_path
from leadflow.sources.sinks import latest_per_key
from leadflow.streaming import funnel, upserts

from .frames import rows

SCHEMA = "id int, t string, seq int"


def changes(spark, root):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")


def drop(spark, root, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")


def test_upsert_over_several_batches(spark):
    root = scratch_path(spark, "s")
    drop(spark, root, [(1, "a", 1), (1, "b", 3), (2, "x", 1)])
    drop(spark, root, [(1, "late", 2), (3, None, 1)])
    run = lambda: upserts.stream_upsert(
        changes(spark, root), f"{root}/out", f"{root}/cp", ["id"], ["seq"]).awaitTermination()
    run()
    current = lambda base=None: upserts.current_rows(spark, f"{root}/out", ["id"], ["seq"], base)
    assert rows(current(), "id", "t") == [(1, "b"), (2, "x"), (3, None)]
    drop(spark, root, [(2, "y", 2)])
    run()
    assert rows(current(), "id", "t") == [(1, "b"), (2, "y"), (3, None)]
    batch = latest_per_key(spark.read.schema(SCHEMA).parquet(f"{root}/in"), ["id"], ["seq"])
    assert rows(current(), "id", "t") == rows(batch, "id", "t")
    base = spark.createDataFrame([(9, "old", 0), (1, "old", 0)], SCHEMA)
    assert rows(upserts.compact(spark, f"{root}/out", f"{root}/base", ["id"], ["seq"], base), "id", "t") == [
        (1, "b"), (2, "y"), (3, None), (9, "old")]


def test_replayed_batch_replaces_its_own_output(spark):
    """The checkpoint is lost and all batches run again into the same folder."""
    root = scratch_path(spark, "r")
    drop(spark, root, [(1, "a", 1)])
    drop(spark, root, [(1, "b", 2)])
    for checkpoint in ("cp1", "cp2"):
        upserts.stream_upsert(changes(spark, root), f"{root}/out", f"{root}/{checkpoint}", ["id"], ["seq"]).awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 2
    assert rows(upserts.current_rows(spark, f"{root}/out", ["id"], ["seq"]), "id", "t") == [(1, "b")]


def test_late_events_are_dropped(spark):
    root = scratch_path(spark, "f")
    start = datetime(2024, 3, 10, 12)

    def put(*offsets):
        spark.createDataFrame([(start + timedelta(days=o), "A") for o in offsets], "ts timestamp, category string") \
            .coalesce(1).write.mode("append").parquet(f"{root}/in")

    def run():
        events = spark.readStream.schema("ts timestamp, category string").option("maxFilesPerTrigger", 1) \
            .parquet(f"{root}/in")
        counts = funnel.daily_funnel(events, "ts", ["category"], {"n": F.lit(1)}, delay="2 days")
        funnel.stream_daily_funnel(counts, f"{root}/out", f"{root}/cp").awaitTermination()

    put(0, 0, 1)
    run()
    put(10)
    run()
    put(0, 9, 10)     # the first is far behind the newest event
    run()
    got = upserts.current_rows(spark, f"{root}/out", ["date", "category"], ["seq"])
    counts = {(r.date - start.date()).days: r.n for r in got.collect()}
    assert counts == {0: 2, 1: 1, 9: 1, 10: 2}


def test_same_counts_on_a_batch(spark):
    data = [(datetime(2024, 3, 1, 1), "A"), (datetime(2024, 3, 1, 23), "A"), (datetime(2024, 3, 2), "B")]
    df = spark.createDataFrame(data, "ts timestamp, category string")
    got = funnel.daily_funnel(df, "ts", ["category"], {"n": F.lit(1)})
    assert sorted((r.category, r.n) for r in got.collect()) == [("A", 2), ("B", 1)]
