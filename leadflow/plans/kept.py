"""KPIs that a run keeps up to date by what it changes, instead of adding up all facts at each refresh.

    kept = KeptKpis(spark, root)
    run_pipeline(run, ..., on_change=kept.on_change)     # each changed table: old rows off, new rows on
    kept.ads_adl(as_of)                                  # from the sums

Every source table of a KPI has sums of its own, numbered by the table's publications, so a run that is repeated counts
nothing twice and a table that has not changed costs nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.calendar import in_calendar
from ..operators.deltas import KeptSums
from ..operators.facts import Layout, fact_union
from ..sources import batches
from ..sources.warehouse import FrameTables, Tables
from . import sales
from .pipeline import Change


@dataclass(frozen=True)
class Kpi:
    """A KPI's layout, and the facts of each of its source tables."""

    layout: Layout
    facts: Mapping[str, Callable[[Tables], DataFrame]]


KPIS = {"ads_adl": Kpi(sales.ADS_ADL, {"appointment": sales.visit_rows, "sale": sales.deal_rows})}


class KeptKpis:
    """The sums of some KPIs under ``root``, by KPI and table."""

    def __init__(self, spark: SparkSession, root: str, kpis: Mapping[str, Kpi] = KPIS):
        self.spark, self.root, self.kpis = spark, root, kpis

    def _sums(self, kpi: str, table: str) -> KeptSums:
        return KeptSums(self.spark, f"{self.root}/_sums/{kpi}/{table}", self.kpis[kpi].layout)

    def on_change(self, change: Change) -> None:
        """Count a table's change into the sums of all KPIs that it feeds."""
        for name, kpi in self.kpis.items():
            if facts := kpi.facts.get(change.table):
                rows = [[facts(FrameTables(self.spark, {change.table: df}))] if df is not None else [] for df in (change.old, change.new)]
                kept = self._sums(name, change.table)
                kept.refresh(change.number, *rows)
                kept.fold()

    def sums(self, name: str, after: date, through: date) -> DataFrame:
        """The KPI's sums by day and keys over all its tables, as far as they were loaded."""
        kpi = self.kpis[name]
        days = in_calendar(F.col(kpi.layout.day), after, through)
        loaded = [t for t in kpi.facts if batches.live(self.spark, self._sums(name, t).folder)]
        return fact_union([self._sums(name, t).sums(days) for t in loaded], kpi.layout)

    def ads_adl(self, as_of: date, after: date = sales.SINCE) -> DataFrame:
        return sales.ads_adl_of_sums(self.sums("ads_adl", after, as_of), as_of, after)
