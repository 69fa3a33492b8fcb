"""Sales: issued appointments, sold and canceled deals, and dollars per lead and per sale."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    NON_SALES_SOURCES, SALES_APPOINTMENT_TYPES, SALES_DEPARTMENT, SERVICE_CATEGORY,
    SERVICE_SALE_TYPES,
)
from ..functions.numbers import COUNT, MONEY, safe_ratio
from ..functions.text import ci_eq, ci_in, ci_ne, ci_not_in, conform_name, fold
from ..operators.calendar import in_calendar
from ..operators.deltas import KeptSums
from ..operators.facts import Fact, Layout, calendar_left, daily_facts, fact_rows, fact_union, merge_case
from ..sources.warehouse import Tables

SINCE = date(2018, 1, 1)
c = F.col


def sales_visit() -> Column:
    """Appointment of the sales department; a NULL category or source counts."""
    return (ci_ne("category", SERVICE_CATEGORY, keep_null=True)
            & ci_not_in("source_type", NON_SALES_SOURCES, keep_null=True)
            & ci_in("appt_type", SALES_APPOINTMENT_TYPES)
            & ci_eq("rep_dept", SALES_DEPARTMENT))


def sales_deal() -> Column:
    """Sale of the sales department; a NULL sale type does not count."""
    return ci_not_in("sale_type", SERVICE_SALE_TYPES) & ci_eq("department", SALES_DEPARTMENT)


def _sold_and_canceled(keys: dict[str, Column]) -> list[Fact]:
    return [
        Fact(c("sold_on"), keys,
             {"sold": c("sold"), "price": c("sold_price"), "sold_total": c("total_sales")}, sales_deal()),
        Fact(c("canceled_date"), keys,
             {"cancelled": c("canceled").cast("int"), "cancelled_amount": c("canceled_amt")}, sales_deal()),
    ]


_VISIT = ("start_on", "issued_unique", "category", "source_type", "appt_type", "rep_dept")
_DEAL = ("sold_on", "canceled_date", "sold", "sold_price", "total_sales", "canceled", "canceled_amt",
         "sale_type", "department")


ADS_ADL = Layout({}, {"issued": COUNT, "sold": COUNT, "price": MONEY, "sold_total": MONEY,
                      "cancelled": COUNT, "cancelled_amount": MONEY}, fill=None)


def visit_rows(tables: Tables, span: tuple[date, date] | None = None) -> DataFrame:
    """Issued leads of the ADL, of all days or of a span."""
    return fact_rows(tables("appointment", *_VISIT),
                     [Fact(c("start_on"), {}, {"issued": c("issued_unique")}, sales_visit())], ADS_ADL, span)


def deal_rows(tables: Tables, span: tuple[date, date] | None = None) -> DataFrame:
    """Sold and canceled deals of the ADS and ADL."""
    return fact_rows(tables("sale", *_DEAL), _sold_and_canceled({}), ADS_ADL, span)


def ads_adl_rows(tables: Tables, span: tuple[date, date] | None = None) -> list[DataFrame]:
    return [visit_rows(tables, span), deal_rows(tables, span)]


def _ads_adl(day: DataFrame) -> DataFrame:
    zero = F.lit(0)
    net = c("sold_total") - F.coalesce("cancelled_amount", zero)
    return day.select(
        "date",
        safe_ratio(net, "issued").alias("adl"),
        safe_ratio(net, c("sold") - F.coalesce("cancelled", zero), guard="price").alias("ads"),
    )


def ads_adl(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    """Per day: net dollars per issued lead (ADL) and per net sale (ADS)."""
    span = (after, as_of)
    return _ads_adl(daily_facts(ads_adl_rows(tables, span), ADS_ADL, span))


def ads_adl_kept(kept: KeptSums, as_of: date, after: date = SINCE) -> DataFrame:
    """The same from sums that batches keep up to date."""
    return ads_adl_of_sums(kept.sums(in_calendar(c("date"), after, as_of)), as_of, after)


def ads_adl_of_sums(sums: DataFrame, as_of: date, after: date = SINCE) -> DataFrame:
    return _ads_adl(calendar_left(sums, ADS_ADL, after, as_of))


def ads_adl_by_staff(tables: Tables, as_of: date, first_year: int = 2019) -> DataFrame:
    """Per day, staff and category: issued, quoted, sold, canceled, ADL and ADS."""
    layout = Layout({"staff": "string", "product_category": "string"},
                    {"issued_unique": COUNT, "quoted": COUNT, "sold": COUNT, "cancelled": COUNT,
                     "price": MONEY, "sold_total": MONEY, "cancelled_amount": MONEY})
    span = (date(first_year - 1, 12, 31), as_of)
    keys = {"staff": conform_name("rep"), "product_category": c("category")}
    rows = [
        fact_rows(tables("appointment", "rep", "quoted", *_VISIT),
                  [Fact(c("start_on"), keys, {"issued_unique": c("issued_unique"), "quoted": c("quoted")},
                        sales_visit())], layout, span),
        fact_rows(tables("sale", "rep", "category", *_DEAL), _sold_and_canceled(keys), layout, span),
    ]
    sums = daily_facts(rows, layout)
    zero = F.lit(0)
    net = c("sold_total") - F.coalesce("cancelled_amount", zero)
    return sums.select(
        "date", "staff", "product_category", "issued_unique", "quoted", "sold",
        c("cancelled").alias("total_cancelled"), c("sold_total").alias("total_sold"),
        c("cancelled_amount").alias("total_cancelled_amount"),
        safe_ratio(net, "issued_unique").alias("adl"),
        safe_ratio(net, c("sold") - F.coalesce("cancelled", zero), guard="price").alias("ads"),
    )


def sale_appt(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    """Per day and staff: issued, quoted and sold appointments; NULL category or source is out."""
    measures = ("issued", "quoted", "unique_issued", "appt_sold")
    layout = Layout({"staff": "string"}, dict.fromkeys(measures, COUNT))
    span = (after, as_of)
    where = (ci_ne("category", SERVICE_CATEGORY) & ci_not_in("source_type", NON_SALES_SOURCES)
             & ci_in("appt_type", SALES_APPOINTMENT_TYPES))
    rows = fact_rows(
        tables("appointment", "start_on", "rep", "issued", "quoted", "issued_unique", "sold",
               "category", "source_type", "appt_type"),
        [Fact(c("start_on"), {"staff": c("rep")},
              {"issued": c("issued"), "quoted": c("quoted"), "unique_issued": c("issued_unique"),
               "appt_sold": c("sold")}, where)], layout, span)
    day = daily_facts([rows], layout, span)
    return day.select("date", "staff", *[F.coalesce(m, F.lit(0)).alias(m) for m in measures])


def sale_sold_canceled(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    """Per day and staff: sold and canceled.  A cancellation shows on the day of its sale."""
    layout = Layout({"staff": "string"},
                    {"sale_sold": COUNT, "sale_cancelled": COUNT, "sold_price": MONEY,
                     "cancelled_amt": MONEY, "total_sale": MONEY})
    span = (after, as_of)
    sold = c("sold_on").isNotNull()
    canceled = c("canceled_date").isNotNull()
    zero = F.lit(0)
    rows = fact_rows(
        tables("sale", "rep", "sold_on", "canceled_date", "sold", "sold_price", "total_sales", "canceled",
               "canceled_amt", "sale_type"),
        [Fact(F.coalesce("sold_on", "canceled_date"), {"staff": c("rep")}, {
            "sale_sold": F.when(sold, c("sold")).otherwise(zero),
            "sold_price": F.when(sold, c("sold_price")).otherwise(zero),
            "total_sale": F.when(sold, c("total_sales")).otherwise(zero),
            "sale_cancelled": F.when(canceled, c("canceled").cast("int")).otherwise(zero),
            "cancelled_amt": F.when(canceled, c("canceled_amt")).otherwise(zero),
        }, ci_not_in("sale_type", SERVICE_SALE_TYPES), days=(c("sold_on"), c("canceled_date")))], layout, span)
    return daily_facts([rows], layout, span)


def sales_staff_location(tables: Tables, as_of: date) -> DataFrame:
    """Per day, staff, category and city: issued, sold, canceled.

    An appointment counts only if its category occurs on a sale.  That semi join
    runs on the summed appointments: categories are few, so joining the raw rows
    would send a large part of them to one task.
    """
    layout = Layout({"staff": "string", "product_category": "string", "city": "string"},
                    {"issued_unique": COUNT, "sold": COUNT, "cancelled": COUNT, "price": MONEY,
                     "sold_total": MONEY, "cancelled_amount": MONEY})
    keys = {"staff": conform_name("rep"), "product_category": c("category"), "city": c("city")}
    no_later = c("date") <= F.lit(as_of)
    visits = fact_union([fact_rows(
        tables("appointment", "rep", "city", *_VISIT),
        [Fact(c("start_on"), keys, {"issued_unique": c("issued_unique")}, sales_visit())],
        layout).where(no_later)], layout)
    deals = fact_union([fact_rows(tables("sale", "rep", "category", "city", *_DEAL),
                                  _sold_and_canceled(keys), layout).where(no_later)], layout)
    sums = merge_case(semi_category(visits, tables("sale", "category")).unionByName(deals), layout)
    out = {"issued_unique": "issued_unique", "sold": "sold", "cancelled": "total_cancelled",
           "price": "total_price", "sold_total": "total_sold", "cancelled_amount": "total_cancelled_amount"}
    return sums.select("date", "staff", "product_category", c("city").alias("appointment_location"),
                       *[F.coalesce(m, F.lit(0)).alias(o) for m, o in out.items()])


def semi_category(sums: DataFrame, sales: DataFrame, column: str = "product_category") -> DataFrame:
    """Rows whose category occurs on at least one sale, whatever the case."""
    known = sales.select("category").distinct().select(fold("category").alias("_known"))
    return sums.join(known, fold(column) == c("_known"), "left_semi")


def sale_prod_service_cat(tables: Tables) -> DataFrame:
    """Actual production, service and standard dollars per day and category.

    Production (by the foreman's sale day) and sales (by the day sold) stay
    separate rows, as two rows of the same day and category.
    """
    layout = Layout({"kind": "string", "product_category": "string"},
                    {"prod": MONEY, "service": MONEY, "std": MONEY}, conformed=("kind",))
    zero = F.lit(0)
    key = {"product_category": c("category")}
    rows = fact_rows(
        tables("sale", "foreman_sale_date", "foreman_basis", "sold_on", "total_sales", "sale_type", "category"),
        [Fact(c("foreman_sale_date"), {"kind": F.lit("prod"), **key}, {"prod": c("foreman_basis")},
              ci_not_in("sale_type", SERVICE_SALE_TYPES) & c("foreman_sale_date").isNotNull()),
         Fact(c("sold_on"), {"kind": F.lit("sale"), **key}, {
             "service": F.when(ci_in("sale_type", SERVICE_SALE_TYPES), c("total_sales")).otherwise(zero),
             "std": F.when(ci_not_in("sale_type", SERVICE_SALE_TYPES), c("total_sales")).otherwise(zero)})],
        layout)
    return daily_facts([rows], layout).select("date", "product_category", "prod", "service", "std")


def sale_prod_service_actual(tables: Tables, after: date, through: date) -> DataFrame:
    """Actual production, service and net standard dollars for every day of the calendar."""
    layout = Layout({}, {"prod": MONEY, "service": MONEY, "sold": MONEY, "cancelled": MONEY}, fill=None)
    span = (after, through)
    zero = F.lit(0)
    standard = ci_not_in("sale_type", SERVICE_SALE_TYPES)
    in_sales = ci_eq("department", SALES_DEPARTMENT)
    rows = fact_rows(
        tables("sale", "foreman_sale_date", "foreman_basis", "sold_on", "total_sales", "sale_type",
               "department", "canceled_date", "canceled_amt"),
        [Fact(c("foreman_sale_date"), {}, {"prod": c("foreman_basis")}, standard),
         Fact(c("sold_on"), {}, {
             "service": F.when(ci_in("sale_type", SERVICE_SALE_TYPES), c("total_sales")).otherwise(zero),
             "sold": F.when(standard & in_sales, c("total_sales")).otherwise(zero)}),
         Fact(c("canceled_date"), {}, {"cancelled": c("canceled_amt")}, standard & in_sales)],
        layout, span)
    day = daily_facts([rows], layout, span)
    return day.select(
        "date", F.coalesce("prod", zero).alias("prod"), F.coalesce("service", zero).alias("service"),
        (F.coalesce("sold", zero) - F.coalesce("cancelled", zero)).alias("std"))


