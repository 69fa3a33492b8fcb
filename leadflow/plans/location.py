"""The whole funnel by staff and place."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import NON_SALES_SOURCES, SALES_APPOINTMENT_TYPES, SERVICE_CATEGORY
from ..functions.numbers import COUNT
from ..functions.text import ci_contains_any, ci_in, ci_not_in, conform_name, fold, or_empty
from ..operators.attribution import mark_matching
from ..operators.facts import Fact, Layout, daily_facts, fact_rows, sum_measures
from ..sources.warehouse import Tables, keyed, text_day
from .care import new_source, not_service_work, was_canceled, was_set

SINCE = date(2018, 1, 1)
c = F.col
KEYS = dict.fromkeys(("staff", "product_category", "city", "state", "zip", "location", "title"), "string")
MEASURES = dict.fromkeys(("leads_taken", "leads_nd", "appointments_set", "appointments_cancelled",
                          "appointments_issued_sale", "quote_issued", "sale_sold", "sale_cancelled"), COUNT)


def _place(staff: Column) -> dict[str, Column]:
    return {"staff": staff, "product_category": or_empty("category"), "city": or_empty("city"),
            "state": or_empty("state"), "zip": or_empty("zip"), "location": or_empty("address")}


def _rows(tables: Tables, layout: Layout, span: tuple[date, date]) -> list[DataFrame]:
    """The facts of the funnel under the keys of ``layout``: ten from five tables, each table read once."""
    def among(columns: dict[str, Column]) -> dict[str, Column]:
        return {k: v for k, v in columns.items() if k in layout.keys or k in layout.measures}

    def fact(day: Column, keys: dict[str, Column], measures: dict[str, Column] | None = None, **more) -> Fact:
        return Fact(day, among(keys), among(measures or {}), **more)

    zero, one = F.lit(0), F.lit(1)
    leads = keyed(tables, "lead", "id", "prospect_id", "taken_on", "category", "source_type")
    nowhere = {"staff": F.lit(""), "product_category": or_empty("category"), "location": F.lit("")}
    taken = [fact(c("taken_on"), nowhere, {"leads_taken": one}, where=new_source())]
    if "leads_nd" in layout.measures:
        leads = mark_matching(leads, keyed(tables, "prospect", "id"), "on_record")
        taken.append(fact(c("taken_on"), nowhere, {"leads_nd": one}, where=~c("on_record") & new_source() & not_service_work()))
    rep = _place(conform_name("rep"))
    sales_type = ci_in("appt_type", SALES_APPOINTMENT_TYPES)
    sales_visit = (~ci_contains_any(or_empty("category"), [SERVICE_CATEGORY])
                   & ci_not_in("source_type", NON_SALES_SOURCES, keep_null=True) & sales_type)
    place = ("category", "rep", "city", "state", "zip", "address")
    set_on, canceled_on = (text_day(tables, "appointment", d) for d in ("set_on", "canceled_on"))
    return [
        fact_rows(leads, taken, layout, span),
        fact_rows(tables("appointment", set_on.column, canceled_on.column, "start_on", "appt_type", "set_by", "canceled",
                         "source_type", "quoted", "issued", *place), [
            fact(set_on.day, rep, {"appointments_set": was_set()}, where=not_service_work() & new_source(),
                 parsed=set_on.parsed),
            fact(canceled_on.day, rep, {"appointments_cancelled": was_canceled()},
                 where=not_service_work() & new_source(), parsed=canceled_on.parsed),
            # Quotes and issues are taken on the same day under the same keys: one fact.
            fact(c("start_on"), rep, {
                "quote_issued": F.when(sales_type, F.coalesce("quoted", zero)).otherwise(zero),
                "appointments_issued_sale": F.when(sales_visit, F.coalesce("issued", zero)).otherwise(zero),
            }),
        ], layout, span),
        fact_rows(tables("sale", "sold_on", "canceled_date", "sold", "canceled", "appt_type", *place), [
            fact(c("sold_on"), rep, {"sale_sold": F.coalesce("sold", zero)}, where=sales_type),
            fact(c("canceled_date"), rep,
                 {"sale_cancelled": F.coalesce(c("canceled").cast("int"), zero)}, where=sales_type),
        ], layout, span),
        fact_rows(tables("project", "sold_on", *place), [fact(c("sold_on"), rep)], layout, span),
        fact_rows(tables("staff", "start_on", "title"), [
            fact(c("start_on"), {"staff": F.lit(""), "title": c("title")},
                 {"leads_taken": F.lit(None)})], layout, span),
    ]


def staff_location(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    """Per day, staff, category, place and title: leads, appointments, quotes and sales.

    Everything is added up in one shuffle.  Here a lead is qualified only if its prospect is not on record at all.
    Projects and staff carry no measures; they add the days and places (or titles) on which they occur.
    """
    layout = Layout(KEYS, MEASURES)
    span = (after, as_of)
    day = daily_facts(_rows(tables, layout, span), layout, span)
    return day.withColumn("appointments_issued_cc", c("appointments_set") - c("appointments_cancelled"))


PLACES = Layout(dict.fromkeys(("state", "city", "zip"), "string"),
                dict.fromkeys(("leads_taken", "appointments_set", "sale_sold", "sale_cancelled"), COUNT))


def location_rollup(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    """Totals by state, city and zip with subtotals; ``level`` 0 is the zip, 7 the grand total.

    Places that differ in case or accents only are one; the smallest spelling is shown.  The facts are those of
    ``staff_location``, added up by place alone before spellings are merged; days without facts add no place.
    """
    names = list(PLACES.keys)
    stacked = reduce(lambda a, b: a.unionByName(b), _rows(tables, PLACES, (after, as_of)))
    spelt = stacked.groupBy(*names).agg(*sum_measures(PLACES))
    sums = (spelt.withColumns({f"_{n}": fold(n) for n in names}).rollup(*[f"_{n}" for n in names])
            .agg(F.grouping_id().alias("level"), *[F.min(n).alias(n) for n in names],
                 *[F.sum(m).alias(m) for m in PLACES.measures]))
    # level counts the names summed over, as bits from zip (1) to state (4)
    shown = {n: F.when(c("level").bitwiseAND(F.lit(4 >> i)) == 0, c(n)) for i, n in enumerate(names)}
    return sums.withColumns(shown).select(*names, "level", *PLACES.measures)
