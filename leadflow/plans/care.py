"""Customer care: leads taken and qualified, appointments set, canceled and issued."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    EXISTING_DATABASE, SERVICE_WORK, SET_APPOINTMENT_TYPES, UNASSIGNED,
)
from ..functions.numbers import COUNT, flag
from ..functions.text import ci_in, ci_ne, fold, or_empty
from ..operators.attribution import (
    disqualified_prospects, first_touch, lookup_default, mark_matching,
)
from ..operators.calendar import in_calendar, years_before
from ..operators.deltas import KeptSums
from ..operators.facts import Fact, Layout, calendar_left, daily_facts, fact_rows, fact_union, merge_case
from ..sources.warehouse import Tables, keyed, text_day

SINCE = date(2018, 1, 1)
c = F.col
MEASURES = dict.fromkeys(("leads_taken", "leads_nd", "appointments_set", "appointments_cancelled"), COUNT)


def not_service_work() -> Column:
    return ci_ne("category", SERVICE_WORK, keep_null=True)


def new_source(keep_null: bool = True) -> Column:
    return ci_ne("source_type", EXISTING_DATABASE, keep_null=keep_null)


def was_set() -> Column:
    return flag(ci_in("appt_type", SET_APPOINTMENT_TYPES) & c("set_by").isNotNull())


def was_canceled() -> Column:
    return flag(ci_in("appt_type", SET_APPOINTMENT_TYPES) & c("canceled").cast("boolean"))


CARE = Layout({"product_category": "string", "source_type": "string"}, MEASURES)


def lead_rows(tables: Tables, span: tuple[date, date] | None = None) -> DataFrame:
    """Facts of leads; a prospect decides on all its leads."""
    as_is = {"product_category": c("category"), "source_type": c("source_type")}
    emptied = {"product_category": or_empty("category"), "source_type": or_empty("source_type")}
    leads = mark_matching(
        keyed(tables, "lead", "id", "prospect_id", "taken_on", "category", "source_type"),
        disqualified_prospects(keyed(tables, "prospect", "id", "not_qualified_reason")), "turned_away")
    one = F.lit(1)
    return fact_rows(leads, [
        Fact(c("taken_on"), as_is, {"leads_taken": one}, new_source(keep_null=False)),
        Fact(c("taken_on"), emptied, {"leads_nd": one},
             ~c("turned_away") & new_source() & not_service_work()),
    ], CARE, span)


def appointment_rows(tables: Tables, span: tuple[date, date] | None = None) -> DataFrame:
    """Facts of appointments: set and canceled."""
    as_is = {"product_category": c("category"), "source_type": c("source_type")}
    set_on, canceled_on = (text_day(tables, "appointment", d) for d in ("set_on", "canceled_on"))
    appointments = tables("appointment", set_on.column, canceled_on.column, "appt_type", "set_by", "canceled",
                          "category", "source_type")
    return fact_rows(appointments, [
        Fact(set_on.day, as_is, {"appointments_set": was_set()}, not_service_work() & new_source(),
             parsed=set_on.parsed),
        Fact(canceled_on.day, as_is, {"appointments_cancelled": was_canceled()},
             not_service_work() & new_source(), parsed=canceled_on.parsed),
    ], CARE, span)


def _care(day: DataFrame) -> DataFrame:
    full = [F.coalesce(m, F.lit(0)).alias(m) for m in MEASURES]
    return day.select("date", "product_category", "source_type", *full).withColumn(
        "appointments_issued", c("appointments_set") - c("appointments_cancelled"))


def customer_care(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    """Per day, category and source type.

    Leads taken drop an unknown source, the other facts keep it; qualified leads
    show an unknown category or source as the empty text.
    """
    span = (after, as_of)
    return _care(daily_facts([lead_rows(tables, span), appointment_rows(tables, span)], CARE, span))


def customer_care_kept(kept: KeptSums, as_of: date, after: date = SINCE) -> DataFrame:
    """The same from sums that batches keep up to date."""
    return _care(calendar_left(kept.sums(in_calendar(c("date"), after, as_of)), CARE, after, as_of))


def affected_leads(leads: DataFrame, changed_leads: DataFrame, changed_prospects: DataFrame) -> DataFrame:
    """Leads whose facts a batch may change: its own, and those of its prospects.

    Both lists are of one batch's size; each costs a semi join, which Spark broadcasts when it measures them small.
    """
    own = changed_leads.select(F.col("id").alias("_id")).distinct()
    theirs = changed_prospects.select(fold(F.col("id").cast("string")).alias("_id")).distinct()
    by_id = leads.join(own, leads["id"] == own["_id"], "left_semi")
    rest = leads.join(own, leads["id"] == own["_id"], "left_anti")
    return by_id.unionByName(rest.join(theirs, fold(F.col("prospect_id").cast("string")) == theirs["_id"], "left_semi"))


def customer_care_by_staff(tables: Tables, as_of: date, years: int = 5) -> DataFrame:
    """Per day, staff, team lead, category and source type over the last years.

    A lead belongs to whoever set its first appointment.  Facts are first summed
    by staff id; names are looked up on the sums.
    """
    window = (years_before(as_of, years) - timedelta(days=1), as_of)
    set_on, canceled_on = (text_day(tables, "appointment", d) for d in ("set_on", "canceled_on"))
    appointments = tables("appointment", *dict.fromkeys((
        "id", "lead_id", "set_on", set_on.column, canceled_on.column, "appt_type", "set_by", "canceled", "category",
        "source_type", "team_lead")))
    touched = appointments.where(c("lead_id").isNotNull() & in_calendar(set_on.day, *window))
    leads = keyed(tables, "lead", "id", "prospect_id", "taken_on", "category", "source_type").where(
        in_calendar(c("taken_on"), *window) & new_source(keep_null=False))
    leads = mark_matching(
        leads, disqualified_prospects(keyed(tables, "prospect", "id", "not_qualified_reason")), "turned_away")
    owners = first_touch(touched).withColumnRenamed("set_by", "staff_id")
    owned = leads.join(owners, fold("id") == owners["lead_id"], "left")

    by_id = Layout({"staff_id": "string", "own_lead": "string", "from_lead": "boolean",
                    "product_category": "string", "source_type": "string"}, MEASURES)
    keys = {"product_category": or_empty("category"), "source_type": or_empty("source_type")}
    visit = {"staff_id": c("set_by"), "own_lead": c("team_lead"), "from_lead": F.lit(False), **keys}
    rows = [
        fact_rows(owned, [Fact(
            c("taken_on"), {"staff_id": c("staff_id"), "from_lead": F.lit(True), **keys},
            {"leads_taken": F.lit(1), "leads_nd": flag(~c("turned_away") & not_service_work())})], by_id, window),
        fact_rows(appointments, [
            Fact(set_on.day, visit, {"appointments_set": was_set()},
                 c("lead_id").isNotNull() & not_service_work() & new_source(keep_null=False), parsed=set_on.parsed),
            Fact(canceled_on.day, visit, {"appointments_cancelled": was_canceled()},
                 not_service_work() & new_source(), parsed=canceled_on.parsed),
        ], by_id, window),
    ]
    named = lookup_default(
        fact_union(rows, by_id), tables("staff", "id", "name", "team_lead"), "staff_id", "id",
        {"name": "name", "staff_lead": "team_lead"}, {"name": UNASSIGNED})
    named = named.withColumn("team_lead", F.when(c("from_lead"), c("staff_lead")).otherwise(c("own_lead")))
    layout = Layout(dict.fromkeys(("name", "team_lead", "product_category", "source_type"), "string"), MEASURES)
    return merge_case(named, layout).withColumn(
        "appointments_issued", c("appointments_set") - c("appointments_cancelled"))
