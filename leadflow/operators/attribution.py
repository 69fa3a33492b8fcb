"""Leads: qualified or not, who touched them first, lookups with a default."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import disqualified, fold


PROBE = "probe"  # name under which tables may keep the key


def probe_of_lead(reference: str = "prospect_id", own_id: str = "id") -> Column:
    """Join key of a lead.

    A lead without prospect matches nothing but must be kept; all such leads
    would hash to one task, so each gets a key of its own that no prospect has.
    """
    return F.coalesce(F.concat(F.lit("p:"), fold(F.col(reference).cast("string"))),
                      F.concat(F.lit("none:"), F.col(own_id).cast("string")))


def probe_of_prospect() -> Column:
    return F.concat(F.lit("p:"), fold(F.col("id").cast("string")))


def _probed(leads: DataFrame, reference: str, own_id: str) -> DataFrame:
    key = F.col(PROBE) if PROBE in leads.columns else probe_of_lead(reference, own_id)
    return leads.withColumn("_probe", key).drop(PROBE)


def _build(prospects: DataFrame) -> DataFrame:
    key = F.col(PROBE) if PROBE in prospects.columns else probe_of_prospect()
    return prospects.select(key.alias("_probe"))


def disqualified_prospects(prospects: DataFrame) -> DataFrame:
    return prospects.where(disqualified("not_qualified_reason"))


def leads_without(leads: DataFrame, prospects: DataFrame,
                  reference: str = "prospect_id", own_id: str = "id") -> DataFrame:
    """Leads whose prospect is not among ``prospects``; leads without prospect stay."""
    probed = _probed(leads, reference, own_id)
    return probed.join(_build(prospects), "_probe", "left_anti").drop("_probe")


def leads_qualified(leads: DataFrame, prospects: DataFrame) -> DataFrame:
    """Leads whose prospect was not turned away."""
    return leads_without(leads, disqualified_prospects(prospects))


def mark_matching(leads: DataFrame, prospects: DataFrame, flag: str,
                  reference: str = "prospect_id", own_id: str = "id") -> DataFrame:
    """All leads with a boolean: is the prospect among ``prospects``?

    Serves jobs that count all leads and qualified leads from one scan.
    """
    known = _build(prospects).distinct().withColumn("_known", F.lit(True))
    probed = _probed(leads, reference, own_id)
    return (
        probed.join(known, "_probe", "left")
        .withColumn(flag, F.coalesce("_known", F.lit(False)))
        .drop("_probe", "_known")
    )


def first_touch(appointments: DataFrame, lead: str = "lead_id", order: str = "set_on",
                tie: str = "id", value: str = "set_by") -> DataFrame:
    """First appointment of each lead, as ``(lead key, value)``.

    A minimum over ``(order, tie)`` combines inside the map tasks, so a lead
    with very many appointments never lands whole in one task as it would in a
    ranking window.  The key is in lower case.
    """
    return (
        appointments.where(F.col(lead).isNotNull())
        .groupBy(fold(lead).alias(lead))
        .agg(F.min(F.struct(order, tie, value)).alias("_first"))
        .select(lead, F.col(f"_first.{value}").alias(value))
    )


def lookup_default(df: DataFrame, lookup: DataFrame, on: str, lookup_key: str,
                   take: Mapping[str, str], defaults: Mapping[str, str] | None = None) -> DataFrame:
    """Left lookup by key without regard to case; ``take`` maps output to lookup column.

    Call it on aggregated rows: the hot keys are gone by then, and AQE
    broadcasts the lookup only if it measures small at run time.
    """
    defaults = defaults or {}
    keyed = lookup.select(fold(lookup_key).alias("_lk"),
                          *[F.col(c).alias(f"_{o}") for o, c in take.items()])
    joined = df.join(keyed, fold(df[on]) == keyed["_lk"], "left")
    taken = [
        (F.coalesce(f"_{o}", F.lit(defaults[o])) if o in defaults else F.col(f"_{o}")).alias(o)
        for o in take
    ]
    return joined.select(*[df[c] for c in df.columns], *taken)
