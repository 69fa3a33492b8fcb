"""Marketing spend by source, and next to qualified leads."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import COUNT, MONEY, ratio
from ..functions.text import fold
from ..operators.attribution import leads_qualified, lookup_default
from ..operators.facts import Fact, Layout, daily_facts, fact_rows, fact_union, merge_case
from ..operators.marketing import full_outer_cost_leads
from ..sources.warehouse import Tables
from .care import new_source, not_service_work

SINCE = date(2018, 1, 1)
c = F.col


def marketing_cost_by_source(tables: Tables, as_of: date, after: date = SINCE,
                             repeat_total: bool = True) -> DataFrame:
    """Cost per day, source and category.

    With ``repeat_total`` every category of a source and day shows the source's
    whole cost of that day, so a sum over categories over-counts; switch it off
    for each category's own cost.
    """
    layout = Layout({"source": "string", "product_category": "string"}, {"cost": MONEY})
    span = (after, as_of)
    rows = fact_rows(tables("source_cost", "name", "category", "paid_on", "amount"),
                     [Fact(c("paid_on"), {"source": c("name"), "product_category": c("category")},
                           {"cost": c("amount")})], layout, span)
    day = daily_facts([rows], layout, span)
    if repeat_total:
        # By now a source and day has one row per category, so this window stays small.
        whole = Window.partitionBy("date", fold("source"))
        day = day.withColumn("cost", F.sum("cost").over(whole))
    return day.withColumn("cost", F.coalesce("cost", F.lit(0)))


def _leads_by_source(tables: Tables, as_of: date, after: date) -> DataFrame:
    leads = leads_qualified(
        tables("lead", "id", "prospect_id", "taken_on", "category", "source_type")
        .where(new_source() & not_service_work()),
        tables("prospect", "id", "not_qualified_reason"))
    layout = Layout({"source_type": "string"}, {"leads_nd": COUNT})
    span = (after, as_of)
    rows = fact_rows(leads, [Fact(c("taken_on"), {"source_type": c("source_type")},
                                  {"leads_nd": F.lit(1)})], layout, span)
    return daily_facts([rows], layout, span)


def _cost_by_source_type(tables: Tables) -> DataFrame:
    """Cost per day and source type; summed by source id before the type is looked up."""
    by_id = Layout({"source_id": "string"}, {"total_cost": MONEY})
    sums = fact_union([fact_rows(
        tables("source_cost", "marketing_source_id", "paid_on", "amount"),
        [Fact(c("paid_on"), {"source_id": c("marketing_source_id")}, {"total_cost": c("amount")})],
        by_id)], by_id)
    typed = lookup_default(sums, tables("marketing_source", "id", "source_type"), "source_id", "id",
                           {"source_type": "source_type"})
    return merge_case(typed, Layout({"source_type": "string"}, {"total_cost": MONEY}))


def marketing_kpi(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    """Qualified leads and cost per day and source type; cost outside the calendar shows no date."""
    return full_outer_cost_leads(
        _leads_by_source(tables, as_of, after), _cost_by_source_type(tables), after, as_of)


def cost_per_lead(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    """Spend, qualified leads and spend per lead for each source type (any case)."""
    kpi = marketing_kpi(tables, as_of, after)
    sums = kpi.groupBy(fold("source_type").alias("source_type")).agg(
        F.sum("leads_nd").alias("leads_nd"), F.sum("total_cost").alias("total_cost"))
    return sums.withColumn("cost_per_lead", ratio("total_cost", "leads_nd"))


def return_on_spend(tables: Tables) -> DataFrame:
    """Net sales earned per dollar spent, by product category."""
    category = fold("category").alias("product_category")
    spend = tables("source_cost", "category", "amount").groupBy(category).agg(F.sum("amount").alias("total_cost"))
    sales = tables("sale", "category", "net_sales").groupBy(category).agg(F.sum("net_sales").alias("net_sales"))
    return spend.join(sales, "product_category", "left").withColumn("roi", ratio("net_sales", "total_cost"))
