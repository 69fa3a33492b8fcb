"""Service visits and service sales."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import SERVICE_SALE_TYPES, SERVICE_VISIT_TYPES
from ..functions.numbers import COUNT, MONEY, safe_ratio
from ..functions.text import ci_in, conform_name
from ..operators.facts import Fact, Layout, daily_facts, fact_rows
from ..sources.warehouse import Tables

SINCE = date(2018, 1, 1)
c = F.col


def service_visit() -> Column:
    return (c("issued") != 0) & ci_in("appt_type", SERVICE_VISIT_TYPES)


def service_sale() -> Column:
    return ci_in("sale_type", SERVICE_SALE_TYPES)


def service_ads(tables: Tables) -> DataFrame:
    """Per day and staff: issued visits, service sales, and net dollars per issued visit.

    No calendar: sales that were never canceled meet on one row without a date.
    """
    layout = Layout({"staff": "string"},
                    {"issued_unique": COUNT, "sold": COUNT, "cancelled": COUNT, "price": MONEY,
                     "sold_total": MONEY, "cancelled_amt": MONEY})
    keys = {"staff": conform_name("rep")}
    rows = [
        fact_rows(tables("appointment", "start_on", "rep", "issued_unique", "issued", "appt_type"),
                  [Fact(c("start_on"), keys, {"issued_unique": c("issued_unique")}, service_visit())], layout),
        fact_rows(tables("sale", "sold_on", "canceled_date", "rep", "total_sales", "orig_price", "sold",
                         "canceled", "canceled_amt", "sale_type"),
                  [Fact(c("sold_on"), keys,
                        {"sold": c("sold"), "price": c("orig_price"), "sold_total": c("total_sales")},
                        service_sale()),
                   Fact(c("canceled_date"), keys,
                        {"cancelled": c("canceled").cast("int"), "cancelled_amt": c("canceled_amt")},
                        service_sale())], layout),
    ]
    net = c("sold_total") - F.coalesce("cancelled_amt", F.lit(0))
    return daily_facts(rows, layout).withColumn("ads", safe_ratio(net, "issued_unique"))


def service_sales(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    """Per day, staff and category: service visits, sales, cancellations and net sales."""
    layout = Layout({"staff": "string", "product_category": "string"},
                    {"issued_unique": COUNT, "sold": COUNT, "price": MONEY, "total_sales": MONEY,
                     "cancelled_amt": MONEY})
    span = (after, as_of)
    category = {"product_category": c("category")}
    keys = {"staff": c("rep"), **category}
    rows = [
        fact_rows(tables("appointment", "start_on", "rep_consolidated", "category", "issued_unique", "sold",
                         "issued", "appt_type"),
                  [Fact(c("start_on"), {"staff": c("rep_consolidated"), **category},
                        {"issued_unique": c("issued_unique"), "sold": c("sold")}, service_visit())],
                  layout, span),
        fact_rows(tables("sale", "sold_on", "canceled_date", "rep", "category", "sold_price", "total_sales",
                         "canceled_amt", "sale_type"),
                  [Fact(c("sold_on"), keys, {"price": c("sold_price"), "total_sales": c("total_sales")},
                        service_sale()),
                   Fact(c("canceled_date"), keys, {"cancelled_amt": c("canceled_amt")}, service_sale())],
                  layout, span),
    ]
    day = daily_facts(rows, layout, span)
    return day.withColumn("net_sales", c("total_sales") - c("cancelled_amt"))
