"""Load semantics: upsert, insert-ignore, change-only update, snapshot publish.

The functions that combine a target with a batch are plain DataFrame to
DataFrame; where the result is stored is a separate step (``snapshot_replace``),
because a Parquet table must not be overwritten while it is read.  On a table
format that has ``MERGE INTO`` use that for the upsert instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import batches
from .files import finished, remove


def _struct(names: Sequence[str]) -> Column:
    return F.struct(*[F.col(n) for n in names])


def _one_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[str], last: bool) -> DataFrame:
    """One row per key by ``order``, found by a combining aggregate, not a window.

    Keys containing NULL are never duplicates of each other: each such row is
    given a number of its own to group by.
    """
    pick = F.max_by if last else F.min_by
    partial = reduce(or_, [F.col(k).isNull() for k in key])
    rest = [c for c in rows.columns if c not in key]
    return (rows.withColumn("_alone", F.when(partial, F.monotonically_increasing_id()))
            .groupBy(*key, "_alone")
            .agg(pick(_struct(rest), _struct(order)).alias("_row"))
            .select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in rows.columns]))


def latest_per_key(batch: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _one_per_key(batch, key, order, last=True)


def upsert_by_key(target: DataFrame, batch: DataFrame, key: Sequence[str] | None,
                  order: Sequence[str]) -> DataFrame:
    """Target after the batch: its rows replace those of the same key, NULLs included.

    Within the batch the last row by ``order`` wins; target rows the batch does
    not mention stay.  Without a key the batch is appended.  ``order`` columns
    that the target lacks only serve the choice.

    The target is anti-joined with the batch's keys, one row per key: with a
    small batch Spark broadcasts them and the target is not shuffled at all.
    """
    if not key:
        return target.unionByName(batch.select(*target.columns))
    latest = latest_per_key(batch, key, order).select(*target.columns)
    return target.join(latest.select(*key), list(key), "left_anti").unionByName(latest).select(*target.columns)


def insert_ignore(batch: DataFrame, key: Sequence[str], order: Sequence[str],
                  target: DataFrame | None = None) -> DataFrame:
    """Target plus the first batch row of every key it does not hold yet."""
    first = _one_per_key(batch, key, order, last=False)
    if target is None:
        return first
    fresh = first.join(target.select(*key), list(key), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def _outer(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    same = F.lit(True)
    t, b = target.alias("t"), batch.alias("b")
    for k in key:
        same = same & F.col(f"t.{k}").eqNullSafe(F.col(f"b.{k}"))
    return t.withColumn("_old", F.lit(True)).join(b.withColumn("_new", F.lit(True)), same, "full")


def _side(name: str) -> Column:
    return F.when(F.col("_new").isNotNull(), F.col(f"b.{name}")).otherwise(F.col(f"t.{name}"))


def upsert_column(target: DataFrame, batch: DataFrame, key: Sequence[str], column: str) -> DataFrame:
    """Set one column from the batch (one row per key); all other columns keep their value."""
    joined = _outer(target, batch.where(F.col(column).isNotNull()), key)
    return joined.select(*[
        _side(c).alias(c) if c in key
        else F.coalesce(f"b.{c}", f"t.{c}").alias(c) if c == column
        else F.col(f"t.{c}").alias(c)
        for c in target.columns])


def upsert_columns(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Set every cell that the batch (one row per key) has filled; other cells, rows and columns keep their value."""
    joined = _outer(target, batch, key)
    fresh = [c for c in batch.columns if c not in target.columns]
    return joined.select(
        *[_side(c).alias(c) if c in key else F.coalesce(f"b.{c}", f"t.{c}").alias(c) if c in batch.columns else F.col(f"t.{c}").alias(c)
          for c in target.columns], *[F.col(f"b.{c}").alias(c) for c in fresh])


def update_if_changed(target: DataFrame, batch: DataFrame, key: Sequence[str], column: str) -> DataFrame:
    """Key, value after the batch, and what happened: insert, update or none."""
    joined = _outer(target, batch, key)
    old, new = F.col(f"t.{column}"), F.col(f"b.{column}")
    action = (F.when(F.col("_new").isNull() | (F.col("_old").isNotNull() & old.eqNullSafe(new)), "none")
              .when(F.col("_old").isNull(), "insert").otherwise("update"))
    return joined.select(*[_side(k).alias(k) for k in key], _side(column).alias(column), action.alias("action"))


def _is_among(column: str, values: Sequence) -> Column:
    """``column in values`` with NULL as a value like any other."""
    known = F.col(column).isin([v for v in values if v is not None])
    return known | F.col(column).isNull() if None in values else known


def _with_type(df: DataFrame, spark: SparkSession, path: str, column: str) -> DataFrame:
    """Parquet at ``path``; the type of the partition column is that of ``df``, not guessed from folder names."""
    found = spark.read.parquet(path).schema
    for part in found:
        if part.name == column:
            part.dataType = df.schema[column].dataType
    return spark.read.schema(found).parquet(path)


def changed_rows(target: DataFrame, batch: DataFrame, key: Sequence[str],
                 order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """What a keyed batch takes away from ``target`` and what it puts there: old and new rows of the batch's keys."""
    new = latest_per_key(batch, key, order).select(*target.columns)
    return target.join(new.select(*key), list(key), "left_semi").select(*target.columns), new


_TAKEN = "_taken"


def upsert_with_changes(target: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[str],
                        into: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``changed_rows`` and ``upsert_by_key`` by one pass: old rows, new rows, and the target after the batch.

    The latest rows of the batch are worked out once and written to ``<into>/new``; the target's rows are written to
    ``<into>/rows`` with a mark on those that the batch takes away, so they meet the batch's keys once.
    """
    columns, spark = target.columns, target.sparkSession

    def written(df: DataFrame, folder: str) -> DataFrame:
        df.write.parquet(folder)
        return spark.read.schema(df.schema).parquet(folder)

    new = written(latest_per_key(batch, key, order).select(*columns), f"{into}/new")
    whole = reduce(and_, [F.col(k).isNotNull() for k in key])  # a key with NULL in it equals no other
    taken = new.where(whole).select(*key, F.lit(True).alias(_TAKEN))
    rows = written(target.join(taken, list(key), "left").select(*columns, F.coalesce(_TAKEN, F.lit(False)).alias(_TAKEN)), f"{into}/rows")
    old = rows.where(F.col(_TAKEN)).select(*columns)
    return old, new, rows.where(~F.col(_TAKEN)).select(*columns).unionByName(new)


# -- which partition holds a key -----------------------------------------------

BUCKETS = 64
_BUCKET = "key_bucket"


def _bucket(key: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")


def _places(rows: DataFrame, key: Sequence[str], partition: str) -> DataFrame:
    """Rows of the side table: key, partition, bucket.  A key with NULL in it equals no other and is not looked up."""
    whole = reduce(and_, [F.col(k).isNotNull() for k in key])
    return rows.where(whole).select(*key, partition).distinct().withColumn(_BUCKET, _bucket(key))


def _latest_place(rows: DataFrame, key: Sequence[str], partition: str) -> DataFrame:
    return rows.groupBy(*key, _BUCKET).agg(F.max(F.struct(batches.BATCH, partition)).alias("_p")).select(
        *key, F.col(f"_p.{partition}").alias(partition), _BUCKET, F.lit(0).alias(batches.BATCH))


def start_places(target: DataFrame, index: str, key: Sequence[str], partition: str) -> None:
    """Make the side table of a target that has none yet, from its key columns; batch 0 of the index."""
    if not batches.live(target.sparkSession, index):
        places = _places(target, key, partition)
        batches.write_batch(index, 0, places.repartition(_BUCKET), [_BUCKET])


def fold_places(spark: SparkSession, index: str, key: Sequence[str], partition: str, fan: int = batches.FAN) -> None:
    batches.fold(spark, index, lambda rows: _latest_place(rows, key, partition), fan, partition_by=[_BUCKET])


def _held(spark: SparkSession, index: str, keys: DataFrame, key: Sequence[str], partition: str) -> DataFrame:
    """The partitions that hold some keys, from the side table's buckets of these keys alone."""
    wanted = [r[0] for r in keys.select(_bucket(key).alias("b")).distinct().collect()]  # ``BUCKETS`` numbers at most
    places = batches.read(spark, index, F.col(_BUCKET).isin(wanted))
    return _latest_place(places.join(keys, list(key), "left_semi"), key, partition).select(partition)


def upsert_partitions(spark: SparkSession, folder: str, staging: str, batch: DataFrame, key: Sequence[str],
                      order: Sequence[str], partition: str, index: str | None = None, number: int | None = None) -> DataFrame:
    """Upsert into a partitioned folder, rewriting only the partitions the batch touches.

    Touched are the partitions of the batch's rows, NULL among them, and those that hold one of its keys so far: a
    record that moves leaves its old partition.  The latter come from ``index``, a side table of key and partition that
    each batch (counted up by ``number``) adds its own keys to, and of which only the buckets of the batch's keys are
    read; without an index, the key columns of the whole target are.

    The new partitions, and the old and new rows of the batch's keys, are first written whole to ``staging``, a folder
    of this batch alone; only then do they replace the old ones, and the side table follows last.  A run that died in
    between goes on from a finished ``staging`` when called again.
    """
    if (index is None) != (number is None):
        raise ValueError("an index needs the batch's number, and the other way round")
    target = _with_type(batch, spark, folder, partition)
    keys = batch.select(*key).distinct()
    if index:
        start_places(target, index, key, partition)
        held = _held(spark, index, keys, key, partition)
    else:
        held = target.select(*key, partition).join(keys, list(key), "left_semi").select(partition)
    # Names of partitions only, as the file index keeps them on the driver anyway;
    # given as literals they prune the scan.
    touched = [r[0] for r in batch.select(partition).union(held).distinct().collect()]
    affected = target.where(_is_among(partition, touched))
    if not finished(spark, staging):
        old, new = changed_rows(affected, batch, key, order)
        old.write.mode("overwrite").parquet(old_rows(staging))
        new.write.mode("overwrite").parquet(new_rows(staging))
        # few files a partition; a large partition is split over tasks
        upsert_by_key(affected, batch, key, order).hint("rebalance", partition).write.mode("overwrite").partitionBy(partition).parquet(staging)
    staged = _with_type(batch, spark, staging, partition)
    left = [r[0] for r in staged.select(partition).distinct().collect()]
    gone = affected.where(~F.coalesce(_is_among(partition, left), F.lit(False)))
    emptied = [r[0] for r in gone.select(F.regexp_replace("_metadata.file_path", "/[^/]*$", "")).distinct().collect()]
    publish_partitions(spark, staged, folder, partition)
    for path in emptied:
        remove(spark, path)
    if index:
        batches.write_batch(index, number, _places(spark.read.schema(target.schema).parquet(new_rows(staging)), key, partition)
                            .repartition(_BUCKET), [_BUCKET])
    return _with_type(batch, spark, folder, partition)


def old_rows(staging: str) -> str:
    """Where ``upsert_partitions`` leaves the rows that a batch has replaced, for differences of sums."""
    return f"{staging.rstrip('/')}-old"


def new_rows(staging: str) -> str:
    """Where ``upsert_partitions`` leaves the rows that a batch has put in their place."""
    return f"{staging.rstrip('/')}-new"


def publish_partitions(spark: SparkSession, staged: DataFrame, folder: str, partition: str) -> None:
    """Replace in ``folder`` the partitions found in ``staged``, leaving all others alone."""
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(folder))


def stage_cast(df: DataFrame, columns: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rename and cast to a fixed layout of (name, source column, type); bad values become NULL."""
    return df.select(*[F.col(source).try_cast(kind).alias(name) for name, source, kind in columns])


def snapshot_replace(spark: SparkSession, df: DataFrame, view: str, folder: str,
                     keep_old_if_empty: bool = True, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the new ``folder``, then point the view at it; returns the view.

    Readers see the old snapshot until the write has finished.  With
    ``keep_old_if_empty`` an empty result leaves the old snapshot in place; that
    is decided on the written files, so ``df`` is computed once.
    """
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(folder)
    if not (keep_old_if_empty and spark.catalog.tableExists(view)
            and spark.read.schema(df.schema).parquet(folder).isEmpty()):
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{folder}`")
    return spark.table(view)
