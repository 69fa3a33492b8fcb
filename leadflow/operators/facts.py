"""Dated facts: read several off one scan, add them up in one shuffle, lay them
over the calendar.

Shape of every KPI job here::

    table --fact_rows--> (date, keys, measures)   one scan per table
          --fact_union-> sums                     one shuffle for all facts
          --merge_case / calendar_left            a second one, on sums only

The first aggregation groups by the texts exactly as spelled, with fixed-width
buffers, so it hash-aggregates inside each map task: a key that holds a third
of all rows leaves a task as a handful of rows.  Only the result, whose size is
set by days and dimension values and not by the facts, is regrouped without
regard to case.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold
from .calendar import calendar, in_calendar


@dataclass(frozen=True)
class Layout:
    """Columns all facts of a job share.

    ``keys`` and ``measures`` map a name to its SQL type.  ``fill`` is the value
    a fact gives to measures it does not carry: 0, or None to leave them NULL.
    ``conformed`` names text keys that come in one spelling already (ids,
    labels); they need no merging.  ``day`` is the date column.
    """

    keys: Mapping[str, str]
    measures: Mapping[str, str]
    fill: int | None = 0
    conformed: tuple[str, ...] = ()
    day: str = "date"

    @property
    def text_keys(self) -> list[str]:
        """Text keys whose spelling may differ within a group, in case or accents."""
        return [k for k, t in self.keys.items() if t == "string" and k not in self.conformed]


@dataclass(frozen=True)
class Fact:
    """One kind of dated event found on a table's rows.

    ``parsed`` says that the day is worked out from text: a range test on it
    cannot reach the scan, so it is made only once, after the parsing.  ``days``
    names the date columns a day is picked from, if it is no plain column.
    """

    day: Column
    keys: Mapping[str, Column] = field(default_factory=dict)
    measures: Mapping[str, Column] = field(default_factory=dict)
    where: Column | None = None
    parsed: bool = False
    days: tuple[Column, ...] = ()


def fact_rows(df: DataFrame, facts: Sequence[Fact], layout: Layout,
              within: tuple[date, date | Column] | None = None) -> DataFrame:
    """All facts of one table from a single scan.

    A row yields one output row for each fact whose condition (and calendar
    range) it meets; the facts' conditions are also OR-ed into one filter ahead
    of that, so rows that meet none never leave the scan.  That filter implies
    that some day is in the calendar, which is stated apart: text tests cannot
    be pushed, and OR-ed with them no range would reach the scan.  It is
    written with another comparison, or Catalyst factors it back into the OR.
    """
    def condition(fact: Fact, day: Column, ranged: bool = True) -> Column:
        holds = fact.where if fact.where is not None else F.lit(True)
        return holds & in_calendar(day, *within) if within is not None and ranged else holds

    def values(fact: Fact, day: Column) -> list[Column]:
        return ([day.cast("date").alias(layout.day)]
                + [fact.keys.get(k, F.lit(None)).cast(t).alias(k) for k, t in layout.keys.items()]
                + [fact.measures.get(m, F.lit(layout.fill)).cast(t).alias(m)
                   for m, t in layout.measures.items()])

    met = df.where(reduce(or_, [condition(f, f.day, ranged=not f.parsed) for f in facts]))
    if within is not None and not any(f.parsed for f in facts):
        days = [day for f in facts for day in f.days or (f.day,)]
        after, through = within
        met = met.where(reduce(or_, [(day > F.lit(after)) & (day <= through) for day in days]))
    if len(facts) == 1 and not facts[0].parsed:
        return met.select(*values(facts[0], facts[0].day))
    met = met.withColumns({f"_day{i}": f.day for i, f in enumerate(facts)})
    hits = F.array(*[
        F.when(condition(f, F.col(f"_day{i}")), F.struct(*values(f, F.col(f"_day{i}"))))
        for i, f in enumerate(facts)])
    return met.select(F.explode(hits).alias("hit")).where(F.col("hit").isNotNull()).select("hit.*")


def sum_measures(layout: Layout) -> list[Column]:
    return [F.sum(m).alias(m) for m in layout.measures]


def fact_union(rows: Sequence[DataFrame], layout: Layout) -> DataFrame:
    """Stack fact rows and add them up by day and keys, as spelled."""
    stacked = reduce(lambda a, b: a.unionByName(b), rows)
    return stacked.groupBy(layout.day, *layout.keys).agg(*sum_measures(layout))


def merge_case(sums: DataFrame, layout: Layout, unique: bool = False) -> DataFrame:
    """Merge groups whose text keys differ only in case or accents; the smallest spelling is shown.

    The smallest text needs a sort, which compares a hash of the keys first: that settles all but rows of one group.
    With ``unique`` day and keys are those of one row each, so that a group has as many rows as spellings.  Combining them
    ahead of the exchange would sort them to leave nearly as many; they go as they are and are sorted once.
    """
    text = layout.text_keys
    if not text:
        return sums
    exact = [layout.day] + [k for k in layout.keys if k not in text]
    folded = [f"_{k}" for k in text]
    keyed = sums.withColumns({f"_{k}": fold(k) for k in text}).withColumn("_group", F.xxhash64(*exact, *folded))
    return (
        (keyed.repartition("_group") if unique else keyed).groupBy("_group", *exact, *folded)
        .agg(*[F.min(k).alias(k) for k in text], *sum_measures(layout))
        .select(layout.day, *layout.keys, *layout.measures)
    )


_BITMAP = 32768  # days in one bitmap


def _position(day: Column, after: date) -> Column:
    """A day's place in the bitmap of the calendar that begins behind ``after``."""
    return F.date_diff(day, F.lit(after)) - 1


def _has(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))


def _seen(sums: DataFrame, layout: Layout, after: date) -> tuple[Column, Column]:
    """The days met, as a bitmap of 4 kB that the map tasks put together, and a test that all rows of ``sums`` pass.

    Both the groups and the bitmap are to come from one exchange of the sums.  Spark serves the second use by the first
    one's exchange only if both need the same columns, so each looks at all of them: the bitmap beside a count, which
    goes into the test, and the groups by the test.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sums.columns])
    met = F.bitmap_construct_agg(F.when(F.col(layout.day) > F.lit(after), _position(F.col(layout.day), after) % _BITMAP))
    seen = sums.agg(met.alias("days"), F.count_if(row == 0).alias("n")).select(F.struct("days", "n")).scalar()
    return seen["days"], (row != 0) | (seen["n"] >= 0)


def calendar_left(sums: DataFrame, layout: Layout, after: date, through: date | Column) -> DataFrame:
    """Lay sums (one row per day and keys, as spelled) over the calendar: every day shows, days without facts once with
    NULL keys.

    Days outside the calendar are dropped.  Written without a join on the day: such a join would bring all groups of a
    busy day to one task.  The days without facts are found by a bitmap instead and put beside the merged groups.
    """
    sums = sums.where(in_calendar(F.col(layout.day), after, through))
    if isinstance(through, date) and (through - after).days > _BITMAP:
        raise ValueError(f"a calendar of more than {_BITMAP} days")
    if not layout.keys:  # the one group of a day takes up its marker
        markers = calendar(sums.sparkSession, after, through).select(
            F.col("date").alias(layout.day), *[F.lit(None).cast(sums.schema[m].dataType).alias(m) for m in layout.measures])
        return sums.select(layout.day, *layout.measures).unionByName(markers).groupBy(layout.day).agg(*sum_measures(layout))
    days, any_row = _seen(sums, layout, after)
    merged = merge_case(sums.where(any_row), layout, unique=True)
    empty = calendar(sums.sparkSession, after, through).where(~_has(days, _position(F.col("date"), after))).select(
        F.col("date").alias(layout.day), *[F.lit(None).cast(t).alias(k) for k, t in layout.keys.items()],
        *[F.lit(None).cast(merged.schema[m].dataType).alias(m) for m in layout.measures])
    return merged.unionByName(empty)


def daily_facts(rows: Sequence[DataFrame], layout: Layout,
                span: tuple[date, date | Column] | None = None) -> DataFrame:
    """``fact_union`` followed by ``calendar_left`` (with a span) or ``merge_case``."""
    sums = fact_union(rows, layout)
    return calendar_left(sums, layout, *span) if span else merge_case(sums, layout, unique=True)
