"""Silver copies of the raw tables, laid out for the daily jobs.

* Days that come as text get a typed day beside them, so that a job's calendar reaches the scan as a filter.
* Rows lie in folders by month of the table's main day, and within files in the order of that day, so that the smallest
  and largest day of each row group tell most of them apart from a filter.
* Leads and prospects are bucketed by the folded key that they are joined by (``attribution.probe``), in the same number
  of buckets: that join needs no exchange.

``SilverTables`` gives them to the jobs, which find typed days and stored keys by ``warehouse.text_day`` and ``keyed``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import to_day
from ..operators.attribution import PROBE, probe_of_lead, probe_of_prospect
from ..session import shuffles_dropped

MONTH = "month"


@dataclass(frozen=True)
class Silver:
    """The main day of a role and, by text column, the names of its typed days."""

    main: str
    days: Mapping[str, str] = field(default_factory=dict)


LAYOUTS = {
    "appointment": Silver("start_on", {"set_on": "set_day", "canceled_on": "canceled_day"}),
    "sale": Silver("sold_on"), "project": Silver("start_on"), "source_cost": Silver("paid_on"),
}
BUCKETED = {"lead": probe_of_lead, "prospect": probe_of_prospect}


def typed(df: DataFrame, layout: Silver) -> DataFrame:
    """The rows with their typed days and the first day of the main day's month."""
    days = {name: to_day(text) for text, name in layout.days.items() if text in df.columns}
    return df.withColumns(days).withColumn(MONTH, F.trunc(layout.main, "month"))


def _spread(df: DataFrame) -> Column:
    """A hash of the row (maps and variants have none): it splits a day, and the rows without a day, among tasks."""
    hashed = [f"`{f.name}`" for f in df.schema if not any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))]
    return F.xxhash64(*hashed)


def write_silver(df: DataFrame, folder: str, layout: Silver, mode: str = "overwrite") -> None:
    """Months as folders, days in order; ranges of rows by day and hash are dealt to tasks by a sample, so a busy month
    or day is split, and so are the rows without a day."""
    rows = typed(df, layout)
    (rows.repartitionByRange(F.col(MONTH), F.col(layout.main), _spread(df)).sortWithinPartitions(MONTH, layout.main)
     .write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(MONTH).parquet(folder))


def write_silver_parts(parts: Iterable[DataFrame], folder: str, layout: Silver) -> None:
    """``write_silver`` of a table that comes in parts, each added to the months of those before: a month has the files of
    each part, and on disk are the shuffle files of one part at a time."""
    for n, part in enumerate(parts):
        with shuffles_dropped(part.sparkSession):
            write_silver(part, folder, layout, "append" if n else "overwrite")


def write_bucketed(df: DataFrame, table: str, folder: str, role: str, buckets: int) -> None:
    """A catalog table over ``folder``, bucketed by its join key; each task writes one bucket's file."""
    keyed = df.withColumn(PROBE, BUCKETED[role]())
    (keyed.repartition(buckets, PROBE).write.mode("overwrite").bucketBy(buckets, PROBE).sortBy(PROBE)
     .format("parquet").option("compression", "zstd").option("path", folder).saveAsTable(table))


class SilverTables:
    """Silver folders ``<root>/<role>`` and bucketed tables ``<prefix><role>``, before the tables of another source."""

    typed_days = {(role, text): day for role, layout in LAYOUTS.items() for text, day in layout.days.items()}

    def __init__(self, spark: SparkSession, root: str, prefix: str, others, roles: Mapping[str, str]):
        """``roles`` says of each role kept here whether it is a ``folder`` or ``bucketed``."""
        self.spark = spark
        self._root, self._prefix, self._others, self._roles = root, prefix, others, roles
        self.stored_keys = {role: PROBE for role, kind in roles.items() if kind == "bucketed"}

    def __call__(self, role: str, *columns: str) -> DataFrame:
        kind = self._roles.get(role)
        if kind is None:
            return self._others(role, *columns)
        df = self.spark.table(f"{self._prefix}{role}") if kind == "bucketed" else self.spark.read.parquet(f"{self._root}/{role}")
        return df.select(*columns) if columns else df
