"""Keyed upsert in micro-batches.

Each micro-batch is reduced to its latest row per key and written to a folder of its own, named by the batch id, so a
batch that is replayed after a failure replaces its own output.  A batch costs its own size, not the table's; the
current table is the latest row per key over all batches.  ``fold`` merges ranges of batches tier by tier, so that readers
find few folders and a row is rewritten seldom; ``compact`` writes the current table out.

Of two rows of a key that tie in ``order``, that of the later batch wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import batches
from ..sources.batches import BATCH, FAN, Span
from ..sources.sinks import latest_per_key

_BEFORE = -1  # the batch of a base that was there before the stream


def stream_upsert(stream: DataFrame, folder: str, checkpoint: str, key: Sequence[str],
                  order: Sequence[str], every: str | None = None) -> StreamingQuery:
    """Start the upsert.  Without ``every`` it takes what is there and stops.

    A file may come as one row group, which one task must read whole.  Its rows are therefore dealt out by key before they
    are sorted and combined, in pieces of the advisory partition size; a key with very many rows is split among several.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batches.write_batch(folder, batch_id, latest_per_key(batch.hint("rebalance", *key), key, order))

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def current_rows(spark: SparkSession, folder: str, key: Sequence[str], order: Sequence[str],
                 base: DataFrame | None = None) -> DataFrame:
    """The table as of now.  A late or replayed batch loses to a newer row by ``order``."""
    rows = batches.read(spark, folder)
    if rows is None:
        if base is None:
            raise ValueError(f"no batch in {folder} and no base")
        return latest_per_key(base, key, order)
    if base is not None:
        rows = rows.unionByName(base.withColumn(BATCH, F.lit(_BEFORE).cast("bigint")), allowMissingColumns=True)
    return latest_per_key(rows, key, [*order, BATCH]).drop(BATCH)


def fold(spark: SparkSession, folder: str, key: Sequence[str], order: Sequence[str], fan: int = FAN,
         whole: bool = False, clean_up: bool = True) -> list[Span]:
    """Merge the ranges of batches that are due; gives the folders that are read from now on."""
    return batches.fold(spark, folder, lambda rows: latest_per_key(rows, key, [*order, BATCH]), fan, whole, clean_up=clean_up)


def compact(spark: SparkSession, folder: str, into: str, key: Sequence[str], order: Sequence[str],
            base: DataFrame | None = None) -> DataFrame:
    """Write the current table to a new folder, to be the next ``base``."""
    current_rows(spark, folder, key, order, base).write.mode("errorifexists").parquet(into)
    return spark.read.parquet(into)
