"""Access to the input tables by role name.

A KPI job asks for ``tables("sale", "sold_on", "category")`` and gets a frame
with just these columns.  Anything callable that way, with a ``spark``
attribute, will do as a source of tables.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple, Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import to_day


class Tables(Protocol):
    spark: SparkSession

    def __call__(self, role: str, *columns: str) -> DataFrame: ...


class TextDay(NamedTuple):
    """A day that the raw table has as text: the column to read, the day, and whether it is worked out from text."""

    column: str
    day: Column
    parsed: bool


def text_day(tables: Tables, role: str, column: str) -> TextDay:
    """The typed day beside a text column where the tables keep one (``typed_days``), else the text parsed."""
    typed = getattr(tables, "typed_days", {}).get((role, column))
    return TextDay(typed, F.col(typed), False) if typed else TextDay(column, to_day(column), True)


def keyed(tables: Tables, role: str, *columns: str) -> DataFrame:
    """Columns of a role, with the join key that the tables keep for it (``stored_keys``), if any."""
    key = getattr(tables, "stored_keys", {}).get(role)
    return tables(role, *columns, *([key] if key else []))


class CatalogTables:
    """Tables of a Spark database (``raw``/``stage``), one per role.

    ``renames`` maps, per role, our column name to the column in the catalog.
    """

    def __init__(self, spark: SparkSession, database: str | Mapping[str, str],
                 renames: Mapping[str, Mapping[str, str]] | None = None):
        self.spark = spark
        self._database = database
        self._renames = renames or {}

    def _name(self, role: str) -> str:
        if isinstance(self._database, str):
            return f"{self._database}.{role}"
        return self._database[role]

    def __call__(self, role: str, *columns: str) -> DataFrame:
        df = self.spark.table(self._name(role))
        names = self._renames.get(role, {})
        if not columns:
            return df
        return df.select(*[df[names.get(c, c)].alias(c) for c in columns])


class PathTables:
    """Tables as folders ``<root>/<role>`` of one file format."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self._root = root.rstrip("/")
        self._fmt = fmt

    def __call__(self, role: str, *columns: str) -> DataFrame:
        df = self.spark.read.format(self._fmt).load(f"{self._root}/{role}")
        return df.select(*columns) if columns else df


class FrameTables:
    """Tables given as DataFrames, for tests and notebooks."""

    def __init__(self, spark: SparkSession, frames: Mapping[str, DataFrame]):
        self.spark = spark
        self._frames = frames

    def __call__(self, role: str, *columns: str) -> DataFrame:
        df = self._frames[role]
        return df.select(*columns) if columns else df
