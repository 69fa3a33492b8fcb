"""Spend next to leads."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold
from .calendar import in_calendar


def full_outer_cost_leads(leads: DataFrame, cost: DataFrame, after: date, through: date) -> DataFrame:
    """Leads per day and source type beside the cost of the same day and source type.

    ``leads`` covers the calendar, with a NULL-source row on days without leads;
    ``cost`` is any day.  A cost without leads keeps its own row with 0 leads,
    and shows no date if it lies outside the calendar.  NULL sources never match.
    Both sides are sums by day and source type, so the join is small.
    """
    left = leads.select("date", fold("source_type").alias("_src"),
                        F.col("source_type").alias("_lead_source"), "leads_nd")
    right = cost.select("date", fold("source_type").alias("_src"),
                        F.col("source_type").alias("_cost_source"), "total_cost",
                        F.lit(True).alias("_spent"))
    joined = (left.withColumn("_led", F.lit(True))
              .join(right, ["date", "_src"], "full"))
    shown = F.when(F.col("_led") | in_calendar(F.col("date"), after, through), F.col("date"))
    return joined.select(
        shown.alias("date"),
        F.coalesce("_lead_source", "_cost_source").alias("source_type"),
        F.coalesce("leads_nd", F.lit(0)).alias("leads_nd"),
        F.when(F.col("_led"), F.coalesce("total_cost", F.lit(0))).otherwise(F.col("total_cost"))
        .alias("total_cost"),
    )
