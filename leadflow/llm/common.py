"""Small helpers of the operators: saved tables, folds, renamed inputs."""

from __future__ import annotations

import ctypes
import functools
import gc
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadflow.session import scratch_path
from leadflow.sources.files import remove

WORD = r"[^\x20\x09-\x0D]+"


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared scratch folder and read again: what follows no longer depends on executors
    that may be lost, and later uses do not compute it anew."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Deletes the folders of saved frames that nothing reads any more."""
    for df in frames:
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            remove(df.sparkSession, folder)


SLOTS = 1 << 20


def split_by(df: DataFrame, keys: list[str], wanted: DataFrame, wanted_keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose keys may be in ``wanted``, and those whose keys are certainly not.

    Goes by a hash of the keys, so rows are told apart where they lie and only the first part needs a join.  What is broadcast
    are the hashes that occur, a million at most whatever the input; with very many keys more rows pass and none is lost.
    """
    def slot(names: list[str]) -> Column:
        return F.pmod(F.xxhash64(*names), F.lit(SLOTS)).cast("int")
    slots = F.broadcast(saved(wanted.select(slot(wanted_keys).alias("slot")).distinct(), "slots"))
    here = slot(keys) == slots["slot"]
    return df.join(slots, here, "left_semi"), df.join(slots, here, "left_anti")


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; an absent id counts as empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5).cast("int")


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that other columns cannot clash with an operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def tokens_schema(fields: Iterable[tuple[str, str]]) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in fields)


def give_back() -> None:
    """Returns a worker's free memory to the system at the end of a task that needed much: workers live on, and the next
    stage's tasks share the executor with what they keep."""
    gc.collect()
    trim()


def trim() -> None:
    """The same without a search for cycles, for tasks that hold arrays alone."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def settle(spark: SparkSession) -> None:
    """Has the executors' JVMs collect their garbage, ahead of a step: a heap grows to its full size in a long step and
    stays so, beside the Python workers that the next one needs.  It then grows again as far as the step asks."""
    context = spark.sparkContext
    n = 1 if re.match(r"local(\[|$)", context.master) else context.defaultParallelism  # a task for each place
    spark.range(0, n, 1, n).select(F.reflect(F.lit("java.lang.System"), F.lit("gc"))).write.format("noop").mode("overwrite").save()


_KEPT: list = []


def kept_by_worker(make: Callable):
    """``make``, its results kept in the worker for the next tasks of the same step.

    Workers outlive steps, so the tasks of others begin with ``forget``."""
    kept = functools.lru_cache(maxsize=2)(make)
    _KEPT.append(kept)
    return kept


def forget() -> None:
    """Lets go of what the tasks of another step left in this worker; they make it anew if they come again."""
    if any(kept.cache_info().currsize for kept in _KEPT):
        for kept in _KEPT:
            kept.cache_clear()
        give_back()


def thrifty(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, on a worker that holds nothing of other steps, with its free memory given back once its task is through."""
    @functools.wraps(run)
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        yield from run(batches)
        trim()
    return tidy


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
