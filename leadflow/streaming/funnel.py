"""Daily funnel counts as events arrive."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import batches


def daily_funnel(events: DataFrame, ts: str, keys: Sequence[str], measures: Mapping[str, Column],
                 delay: str = "2 days") -> DataFrame:
    """Sums per day and keys; rows later than the delay behind the newest event are dropped.

    Works on a stream and, where the watermark has no effect, on a batch.
    """
    return (events.withWatermark(ts, delay)
            .groupBy(F.window(ts, "1 day").alias("w"), *keys)
            .agg(*[F.sum(e).alias(m) for m, e in measures.items()])
            .select(F.col("w.start").cast("date").alias("date"), *keys, *measures))


def stream_daily_funnel(funnel: DataFrame, folder: str, checkpoint: str,
                        every: str | None = None) -> StreamingQuery:
    """Write each micro-batch's changed days; with the batch id, the newest row of a day wins."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batches.write_batch(folder, batch_id, batch.withColumn("seq", F.lit(batch_id)))

    writer = (funnel.writeStream.outputMode("update")
              .option("checkpointLocation", checkpoint).foreachBatch(write))
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
