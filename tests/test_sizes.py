"""Steps whose cost must not gather in one task or be paid twice."""

import re
from datetime import date

from pyspark.sql import functions as F

from leadflow.operators.facts import Layout, merge_case
from leadflow.sources import sinks
from leadflow.sources.silver import Silver, write_silver
from leadflow.streaming import upserts


def rows(df):
    return sorted(df.collect(), key=str)


def test_silver_rows_without_a_day_or_of_one_day_are_spread(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for name, day in (("none", None), ("one", date(2001, 2, 3))):
            sales = spark.range(0, 4000, 1, 4).select(F.col("id").cast("string"), F.lit(day).cast("date").alias("sold_on"))
            write_silver(sales, f"{tmp_path}/{name}", Silver("sold_on"))
            back = spark.read.parquet(f"{tmp_path}/{name}")
            assert rows(back.select("id", "sold_on")) == rows(sales)
            files = [r[1] for r in back.groupBy(F.input_file_name()).count().collect()]
            assert len(files) > 2 and max(files) < 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_micro_batch_of_one_row_group_is_dealt_out_before_it_is_sorted(spark, tmp_path, monkeypatch):
    plans = []
    write = upserts.batches.write_batch

    def watched(folder, batch, df, *more):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(folder, batch, df, *more)

    monkeypatch.setattr(upserts.batches, "write_batch", watched)
    changes = spark.range(40).selectExpr("if(id < 30, 1, id) as id", "id as at")
    changes.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(changes.schema).parquet(f"{tmp_path}/in")
    upserts.stream_upsert(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", ["id"], ["at"]).awaitTermination()
    assert len(plans) == 1 and re.search(r"Aggregate[\s\S]*RebalancePartitions", plans[0])
    got = upserts.current_rows(spark, f"{tmp_path}/out", ["id"], ["at"])
    assert rows(got) == [(1, 29), *[(i, i) for i in range(30, 40)]]


def test_one_pass_over_the_target_gives_what_two_gave(spark, tmp_path):
    schema = "id string, part int, at int, v string"
    target = spark.createDataFrame([("a", 1, 1, "x"), ("a", 1, 1, "x"), ("b", 1, 1, None), (None, 1, 1, "n"), ("c", 2, 1, "z")], schema)
    batch = spark.createDataFrame([("a", 1, 2, "new"), ("a", 1, 3, "newer"), (None, 1, 5, "m"), (None, 1, 6, "o"), ("d", 1, 2, None)], schema)
    for n, part in enumerate((batch, batch.limit(0))):
        old, new, after = sinks.upsert_with_changes(target, part, ["id", "part"], ["at"], f"{tmp_path}/{n}")
        was, becomes = sinks.changed_rows(target, part, ["id", "part"], ["at"])
        key = lambda df: sorted(map(str, df.select("id", "part", "at", "v").collect()))
        assert key(old) == key(was) and key(new) == key(becomes)
        assert key(after) == key(sinks.upsert_by_key(target, part, ["id", "part"], ["at"]))
        assert after.schema.names == target.columns


def test_spellings_of_unique_sums_are_sorted_once(spark):
    layout = Layout({"who": "string"}, {"n": "bigint"})
    sums = spark.createDataFrame([(date(2001, 1, 1), "José", 1), (date(2001, 1, 1), "JOSE", 2), (date(2001, 1, 1), None, 4),
                                  (date(2001, 1, 2), "jose", 8)], "date date, who string, n bigint")
    assert rows(merge_case(sums, layout, unique=True)) == rows(merge_case(sums, layout))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = merge_case(sums, layout, unique=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(re.findall(r"\bSort \[", plan)) == 1 and "Sort [_group" in plan
