"""Staging: raw daily tables to the fixed layouts the reports read."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import stage_cast
from ..sources.warehouse import Tables
from . import production

_FUNNEL = ("leads_taken", "leads_nd", "appointments_set", "appointments_cancelled",
           "appointments_issued_cc", "appointments_issued_sale")


def _layout(texts: tuple[str, ...], measures: tuple[str, ...], **sources: str):
    """Columns ``date``, texts, then measures as doubles; ``sources`` names differing raw columns."""
    kinds = {"date": "date", **dict.fromkeys(texts, "string"), **dict.fromkeys(measures, "double")}
    return [(name, sources.get(name, name), kind) for name, kind in kinds.items()]


ACTUAL_PROD_CAT = _layout(("type", "product_category"), (*_FUNNEL, "quote_issued", "sold", "cancelled"),
                          quote_issued="quote")
ACTUAL_GOAL_DATE = _layout(("type", "product_category"), (*_FUNNEL, "quote_issued", "sold", "cancelled"))
CUSTOMER_FUNNEL = _layout(
    ("type", "sale_rep", "product_category", "source_name", "source_type", "team_lead"),
    (*_FUNNEL, "quote_issued", "sold_total", "sale_sold", "sale_cancelled", "sale_cancelled_amount", "adl", "ads"),
    sale_sold="sold", sale_cancelled="cancelled", sale_cancelled_amount="cancelled_amount")
CUSTOMER_FUNNEL_GOAL = _layout(("type",), (*_FUNNEL, "quote_issued", "sale_sold", "sale_cancelled"))


def stage_actual_prod_cat(tables: Tables) -> DataFrame:
    return stage_cast(tables("actual_prod_cat"), ACTUAL_PROD_CAT)


def stage_actual_goal_date(tables: Tables) -> DataFrame:
    return stage_cast(tables("actual_goal_date"), ACTUAL_GOAL_DATE)


def stage_customer_funnel(tables: Tables) -> DataFrame:
    return stage_cast(tables("customer_funnel"), CUSTOMER_FUNNEL)


def stage_customer_funnel_goal(tables: Tables) -> DataFrame:
    return stage_cast(tables("goals_by_date"), CUSTOMER_FUNNEL_GOAL)


def vtc_daily_snapshot(tables: Tables, as_of: date, history: DataFrame) -> DataFrame:
    """History of value to complete with the day's row added or replaced.

    An upsert whose one key is known beforehand: a filter does it, no join.
    """
    others = history.where(~F.col("date").eqNullSafe(F.lit(as_of)))
    return others.unionByName(production.vtc_today(tables, as_of))
