"""Measures the dashboards derive from the KPI jobs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import COUNT, ratio, safe_ratio
from ..functions.text import fold
from ..operators.calendar import by_period, year_end, years_before
from ..sources.warehouse import Tables
from . import care, goals, sales

c = F.col


def kpi_vs_goal(stacked: DataFrame, measures: list[str], by: list[str]) -> DataFrame:
    """Actual, goal, percent achieved and met/missed (NULL without a goal), from rows stacked by ``type``."""
    sums = stacked.groupBy(*by).agg(*[
        F.sum(F.when(c("type") == t, c(m))).alias(f"{t}_{m}") for m in measures for t in ("actual", "goal")])
    return sums.withColumns({
        **{f"pct_{m}": safe_ratio(c(f"actual_{m}") * 100, f"goal_{m}") for m in measures},
        **{f"status_{m}": F.when(c(f"actual_{m}") >= c(f"goal_{m}"), "met")
           .when(c(f"goal_{m}").isNotNull(), "missed") for m in measures},
    })


def sales_vs_goal(tables: Tables, as_of: date, after: date) -> DataFrame:
    """Monthly production, service and standard dollars against goal."""
    stacked = goals.sale_prod_service(tables, as_of, after).where(c("date") <= F.lit(year_end(as_of)))
    return kpi_vs_goal(stacked.withColumn("month", F.trunc("date", "month")), ["prod", "service", "std"], ["month"])


def funnel_conversion(tables: Tables, as_of: date, after: date) -> DataFrame:
    """Conversion rates along the care funnel, by product category."""
    day = care.customer_care(tables, as_of, after)
    sums = day.groupBy(fold("product_category").alias("product_category")).agg(*[
        F.sum(m).alias(m) for m in ("leads_taken", "leads_nd", "appointments_set", "appointments_issued")])
    return sums.withColumns({
        "qualified_pct": ratio(c("leads_nd") * 100, "leads_taken"),
        "set_pct": ratio(c("appointments_set") * 100, "leads_nd"),
        "issued_pct": ratio(c("appointments_issued") * 100, "appointments_set"),
    })


def category_rates(tables: Tables, as_of: date, first_year: int) -> DataFrame:
    """Sales, conversion and cancellation rate by product category."""
    day = sales.ads_adl_by_staff(tables, as_of, first_year)
    sums = day.groupBy(fold("product_category").alias("product_category")).agg(*[
        F.sum(m).alias(m) for m in ("issued_unique", "quoted", "sold", "total_cancelled", "total_sold",
                                    "total_cancelled_amount")])
    return sums.withColumns({
        "net_revenue": c("total_sold") - c("total_cancelled_amount"),
        "close_pct": ratio(c("sold") * 100, "issued_unique"),
        "cancel_pct": ratio(c("total_cancelled") * 100, "sold"),
    })


def weekly_trend(tables: Tables, as_of: date, after: date) -> DataFrame:
    """Care funnel by week, weeks starting on Monday."""
    day = care.customer_care(tables, as_of, after)
    return day.groupBy(F.date_trunc("week", "date").cast("date").alias("week")).agg(*[
        F.sum(m).cast(COUNT).alias(m) for m in ("leads_taken", "leads_nd", "appointments_set",
                                                "appointments_cancelled", "appointments_issued")])


def periods(tables: Tables, as_of: date, after: date) -> DataFrame:
    """Sold and canceled totals for every dashboard period, from one pass over the twelve months they lie in."""
    day = sales.sale_sold_canceled(tables, as_of, max(after, years_before(as_of, 1)))
    return by_period(day, "date", as_of, ["sale_sold", "sale_cancelled", "total_sale", "cancelled_amt"])
