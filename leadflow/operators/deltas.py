"""Sums kept up to date by differences, and first touches kept by their smallest row.

A KPI's first step adds up fact rows by day and keys.  These sums can be kept: when a batch replaces some rows of a source
table, the facts of the old rows are taken off and those of the new rows added,

    sums after = sums before - facts(old rows of the changed keys) + facts(their new rows),

so a refresh costs what has changed, and only groups whose facts changed are written.  Differences add up in any order,
which lets them be kept as batches and folded (``sources.batches``); a batch that is written again replaces itself, so a
refresh that died half-way is simply repeated.

A sum of no value is NULL and a group without rows is no group, so each group also carries how many rows it has and how
many of them have a value of each measure.  Amounts are decimals and counts are integers: nothing is lost by taking off
what was added.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import fold
from ..sources import batches
from .facts import Layout

ROWS = "_rows"
_KINDS = {"decimal(18,4)": "decimal(28,4)"}


def _count(measure: str) -> str:
    return f"_n_{measure}"


def _columns(layout: Layout) -> list[str]:
    return [*layout.measures, *[_count(m) for m in layout.measures], ROWS]


def _kind(layout: Layout, column: str) -> str:
    kind = layout.measures.get(column, "bigint")
    if kind.startswith(("double", "float")):
        raise ValueError(f"{column}: differences of {kind} do not add up to the sum")
    return _KINDS.get(kind, kind)


def add_up(differences: DataFrame, layout: Layout) -> DataFrame:
    """Differences by day and keys, without those that come to nothing."""
    columns = _columns(layout)
    sums = differences.groupBy(layout.day, *layout.keys).agg(
        *[F.sum(m).cast(_kind(layout, m)).alias(m) for m in columns])
    return sums.where(reduce(or_, [F.col(m) != 0 for m in columns]))


def difference(old: Sequence[DataFrame], new: Sequence[DataFrame], layout: Layout) -> DataFrame:
    """What fact rows ``new`` in place of ``old`` change in the sums; facts without a day count for nothing."""
    def signed(rows: DataFrame, sign: int) -> DataFrame:
        one = F.lit(sign).cast("bigint")
        return rows.where(F.col(layout.day).isNotNull()).select(
            layout.day, *layout.keys,
            *[(F.coalesce(m, F.lit(0).cast(t)) * sign).cast(_kind(layout, m)).alias(m) for m, t in layout.measures.items()],
            *[F.when(F.col(m).isNotNull(), one).otherwise(0).cast("bigint").alias(_count(m)) for m in layout.measures], one.alias(ROWS))
    parts = [signed(r, -1) for r in old] + [signed(r, 1) for r in new]
    return add_up(reduce(lambda a, b: a.unionByName(b), parts), layout)


def as_sums(differences: DataFrame, layout: Layout) -> DataFrame:
    """The sums that all differences make, as ``facts.fact_union`` gives them."""
    sums = add_up(differences, layout).where(F.col(ROWS) > 0)
    return sums.select(layout.day, *layout.keys, *[
        F.when(F.col(_count(m)) > 0, F.col(m)).alias(m) for m in layout.measures])


class KeptSums:
    """The sums of one layout in a folder of batches."""

    def __init__(self, spark: SparkSession, folder: str, layout: Layout):
        self.spark, self.folder, self.layout = spark, folder, layout

    def refresh(self, batch: int, old: Sequence[DataFrame], new: Sequence[DataFrame]) -> None:
        """Count a batch's changes in; the same batch again replaces its first try."""
        batches.write_batch(self.folder, batch, difference(old, new, self.layout))

    def fold(self, fan: int = batches.FAN, whole: bool = False) -> None:
        batches.fold(self.spark, self.folder, lambda rows: add_up(rows, self.layout), fan, whole)

    def sums(self, where: Column | None = None) -> DataFrame:
        """The sums as of now; ``where`` (days, keys) reaches the scans."""
        rows = batches.read(self.spark, self.folder, where)
        if rows is None:
            raise ValueError(f"no batch in {self.folder}")
        return as_sums(rows, self.layout)


# -- first touch ---------------------------------------------------------------

class KeptTouches:
    """The first appointment of each lead, kept as its smallest row.

    A batch that only adds appointments leaves the smallest of its own rows for each lead.  If it takes away the row that
    is a lead's first, what comes next must be looked up: such leads are worked out again from all their rows, and that
    answer stands for all before it.
    """

    def __init__(self, spark: SparkSession, folder: str, lead: str = "lead_id", order: str = "set_on", tie: str = "id",
                 value: str = "set_by"):
        self.spark, self.folder = spark, folder
        self._names = {"lead": lead, "order": order, "tie": tie, "value": value}
        self._lead, self._touch = lead, (order, tie, value)

    def _smallest(self, appointments: DataFrame) -> DataFrame:
        order, tie, value = self._touch
        return (appointments.where(F.col(self._lead).isNotNull()).groupBy(fold(self._lead).alias(self._lead))
                .agg(F.min(F.struct(order, tie, value)).alias("first")))

    def _merged(self, rows: DataFrame) -> DataFrame:
        """Per lead the last answer that stands for all before it, if any, and the smallest row from there on."""
        parts = F.struct(batches.BATCH, "anew", "first")
        held = rows.groupBy(self._lead).agg(F.collect_list(parts).alias("rows"))  # as many as folders are read, at most
        since = F.coalesce(F.array_max(F.transform(F.filter("rows", lambda r: r["anew"]), lambda r: r[batches.BATCH])),
                           F.lit(-1).cast("bigint"))
        held = held.withColumn("since", since)
        return held.select(self._lead, F.array_min(F.transform(F.filter(F.filter(
            "rows", lambda r: r[batches.BATCH] >= F.col("since")), lambda r: r["first"].isNotNull()), lambda r: r["first"])).alias("first"),
            (F.col("since") >= 0).alias("anew"))

    def refresh(self, batch: int, old: DataFrame | None, new: DataFrame, after: DataFrame | None = None) -> None:
        """Count a batch in: rows taken away, rows put there, and all appointments as they are after it.

        ``after`` is read only for the leads that have lost their first row, found by the key's columns.
        """
        added = self._smallest(new).withColumn("anew", F.lit(False))
        state = self._state(before=batch)  # without a first try of this batch
        if old is not None and state is not None:
            lost = old.where(F.col(self._lead).isNotNull()).select(
                fold(self._lead).alias(self._lead), F.struct(*self._touch).alias("_gone")).join(state, self._lead) \
                .where(F.col("_gone").eqNullSafe(F.col("first"))).select(self._lead).distinct()
            again = after.join(lost.select(F.col(self._lead).alias("_lost")), fold(self._lead) == F.col("_lost"), "left_semi")
            # a lead without any row left still needs an answer, that there is none
            anew = lost.join(self._smallest(again), self._lead, "left").withColumn("anew", F.lit(True))
            added = added.join(lost, self._lead, "left_anti").unionByName(anew)
        batches.write_batch(self.folder, batch, added)

    def _state(self, before: int | None = None) -> DataFrame | None:
        rows = batches.read(self.spark, self.folder, before=before)
        return None if rows is None else self._merged(rows)

    def fold(self, fan: int = batches.FAN, whole: bool = False) -> None:
        batches.fold(self.spark, self.folder, self._merged, fan, whole)

    def touches(self) -> DataFrame:
        """``(lead key, value)`` as ``attribution.first_touch`` gives them."""
        return self._state().where("first is not null").select(
            self._lead, F.col(f"first.{self._touch[2]}").alias(self._touch[2]))

