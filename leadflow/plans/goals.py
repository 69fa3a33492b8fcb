"""Daily goals from yearly amounts, and the funnel and category reports built on them."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import GOAL_ROW_TYPE, RATE_ROW_TYPE
from ..functions.numbers import ratio
from ..functions.text import ci_eq, fold
from ..operators.calendar import year_end
from ..operators.goals import (
    allocate_daily, allocate_monthly, amount_rows, even_split_daily, funnel_chain, month_days, seasonal_share,
    spread_days, stack_actual_goal, with_rates, year_totals,
)
from ..sources.warehouse import Tables
from .sales import sale_prod_service_actual
from .sales import sale_prod_service_cat as sale_prod_service_cat_actual

SINCE = date(2019, 1, 1)
NAMED_SINCE = date(2016, 1, 1)
c = F.col


def _company_goal(tables: Tables, as_of: date, after: date, metrics: Mapping[str, tuple[str, str]]) -> DataFrame:
    goals = amount_rows(tables("yearly_goals", "year", "type", *[g for g, _ in metrics.values()]))
    shares = tables("monthly_distribution", "year", "month", *dict.fromkeys(s for _, s in metrics.values()))
    daily = allocate_daily(goals, shares, metrics, after, year_end(as_of))
    return daily.select("date", F.lit("goal").alias("type"), *metrics)


def crew_weeks_goal(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    return _company_goal(tables, as_of, after, {"crew_goal": ("crew_goals", "prod_prod")})


def sale_prod_goal(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    return _company_goal(tables, as_of, after, {"prod_sale_amount": ("prod", "prod_sale")})


def sale_sale_goal(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    return _company_goal(tables, as_of, after, {
        "sale_count": ("sale_count", "sales_value"), "sale_amount": ("sold_amount", "sales_value")})


def service_goal(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    return _company_goal(tables, as_of, after, {
        "service_sale": ("service", "service_sale"), "service_stop": ("service_stop", "service_sale")})


def service_prod_goal(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    return _company_goal(tables, as_of, after, {
        "service_prod_stop": ("service_prod_stop", "service_prod"),
        "service_prod_sale": ("service_prod_sale", "service_prod")})


def service_wcc_goal(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    return _company_goal(tables, as_of, after, {"wcc": ("wcc", "service_wcc")})


def prod_prod_goal(tables: Tables, as_of: date, after: date = SINCE, fan_out: bool = True) -> DataFrame:
    """Production and crew goal per day.

    With ``fan_out`` a year with k goal types counts each sum k times: every
    production row of a day meets every crew row.  Both come from the same rows,
    so this is a factor, the row count of the month, and needs no join.
    """
    goals = amount_rows(tables("yearly_goals", "year", "type", "prod_prod", "crew_goals"))
    shares = tables("monthly_distribution", "year", "month", "prod_prod").withColumnRenamed("prod_prod", "share")
    monthly = allocate_monthly(goals, shares, {"prod_goal": ("prod_prod", "share"),
                                               "crew_goal": ("crew_goals", "share")})
    times = F.count("*") if fan_out else F.lit(1)
    sums = monthly.groupBy("year", "month").agg(
        (F.sum("prod_goal") * times).alias("prod_goal"), (F.sum("crew_goal") * times).alias("crew_goal"))
    return spread_days(sums, after, year_end(as_of)).select(
        "date", F.lit("goal").alias("type"), "prod_goal", "crew_goal")


GOAL_BY_CATEGORY = {
    "leads_nd": ("leads_nd", "value"),
    **{m: (m, "sales_value") for m in ("issued_unique", "quoted", "sold", "canceled", "net", "adl")},
    **{m: (m, "service_sale") for m in ("sale_service", "sale_service_net_amt")},
}


def goal_by_category(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    return allocate_daily(
        tables("goal_distribution", "year", "product_category", *GOAL_BY_CATEGORY),
        tables("monthly_distribution", "year", "month", "value", "sales_value", "service_sale"),
        GOAL_BY_CATEGORY, after, year_end(as_of), keys=["product_category"], total=False)


def goal_marketing_spend(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    daily = allocate_daily(
        tables("goal_distribution", "year", "product_category", "leads_nd", "marketing"),
        tables("monthly_distribution", "year", "month", "value"),
        {"leads_count": ("leads_nd", "value"), "expenditure": ("marketing", "value")},
        after, year_end(as_of), keys=["product_category"])
    return daily.withColumn("type", F.lit("goal"))


def prod_goal(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    daily = allocate_daily(
        tables("product_yearly_goals", "year", "product_category", "prod"),
        tables("monthly_distribution", "year", "month", "prod_prod"),
        {"prod_goal": ("prod", "prod_prod")}, after, year_end(as_of), keys=["product_category"])
    return daily.withColumn("type", F.lit("goal"))


def sale_amount_goal(tables: Tables, as_of: date, after: date = NAMED_SINCE) -> DataFrame:
    return allocate_daily(
        tables("goal_distribution_name", "year", "product_category", "name", "net_sale", "net_sale_count"),
        tables("monthly_distribution", "year", "month", "sales_value"),
        {"goal": ("net_sale", "sales_value"), "net_sale_count": ("net_sale_count", "sales_value")},
        after, year_end(as_of), keys=["product_category", "name"], total=False)


# -- actuals beside goals ---------------------------------------------------

CATEGORY_GOALS = {
    "leads_taken": "leads_taken", "leads_nd": "leads_nd", "appointments_set": "appointment_set",
    "appointments_cancelled": "appointment_canceled", "appointments_issued": "appointment_issued",
    "quote_issued": "quoted", "sold": "sale_sold", "cancelled": "sale_cancelled",
    "total_cost": "marketing", "prod": "prod", "service": "service", "std": "std",
}


def _by_day_and_category(df: DataFrame, **sums) -> DataFrame:
    return (df.groupBy("date", fold("product_category").alias("_category"))
            .agg(*[e.alias(n) for n, e in sums.items()]))


def product_category_actual(tables: Tables) -> DataFrame:
    """Actual funnel, cost and sales per day and category.

    The day's cost and sales repeat on every funnel row of the day and category.
    All three inputs are summed first; the repetition is a product with the
    number of funnel rows, so the joins see one row per day and category.
    """
    funnel_sums = {
        "leads_taken": "leads_taken", "leads_nd": "leads_nd", "appointments_set": "appointments_set",
        "appointments_cancelled": "appointments_cancelled", "appointments_issued": "appointments_issued_cc",
        "quote_issued": "quote_issued", "sold": "sold", "cancelled": "cancelled",
    }
    funnel = _by_day_and_category(
        tables("stage_actual_prod_cat", "date", "product_category", *funnel_sums.values()),
        product_category=F.min("product_category"), _rows=F.count("*"),
        **{o: F.sum(s) for o, s in funnel_sums.items()})
    cost = _by_day_and_category(
        tables("marketing_daily", "date", "product_category", "per_lead_cost", "total_cost"),
        per_lead_cost=F.sum("per_lead_cost"), total_cost=F.sum("total_cost"))
    sales = _by_day_and_category(
        tables("sale_rep_prod_cat", "date", "product_category", "prod", "service", "std"),
        prod=F.sum("prod"), service=F.sum("service"), std=F.sum("std"))
    joined = (funnel.join(cost, ["date", "_category"], "left")
              .join(sales, ["date", "_category"], "left"))
    repeated = ("per_lead_cost", "total_cost", "prod", "service", "std")
    return joined.select(
        "date", "product_category", *funnel_sums,
        *[(F.coalesce(m, F.lit(0)).cast("double") * c("_rows")).alias(m) for m in repeated])


def product_category(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    goal = even_split_daily(
        tables("product_yearly_goals", "year", "product_category", *CATEGORY_GOALS.values()),
        CATEGORY_GOALS, after, year_end(as_of), keys=["product_category"],
    ).withColumn("per_lead_cost", ratio("total_cost", "leads_nd"))
    return stack_actual_goal(product_category_actual(tables), goal)


def sale_prod_service_cat(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    goal = even_split_daily(
        tables("product_yearly_goals", "year", "product_category", "prod", "service", "std"),
        {m: m for m in ("prod", "service", "std")}, after, year_end(as_of), keys=["product_category"])
    actual = sale_prod_service_cat_actual(tables)
    return stack_actual_goal(_as_double(actual, "prod", "service", "std"), goal)


def _as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({m: c(m).cast("double") for m in columns})


def sale_prod_service(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    """Company-wide actuals, and the yearly goal spread by the seasonal share of earlier years."""
    metrics = ("prod", "service", "std")
    through = year_end(as_of)
    actual = sale_prod_service_actual(tables, after, through)
    monthly = actual.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(
        *[F.sum(m).cast("double").alias(m) for m in metrics])
    shares = seasonal_share(monthly, metrics)
    yearly = tables("yearly_goals", "year", "type", *metrics).where(ci_eq("type", GOAL_ROW_TYPE))
    shares = shares.select("year", "month", *[(c(m) / 100).alias(f"share_{m}") for m in metrics])
    goal = spread_days(allocate_monthly(yearly, shares, {m: (m, f"share_{m}") for m in metrics}), after, through)
    return stack_actual_goal(_as_double(actual, *metrics), goal.select("date", *metrics))


# -- rates ------------------------------------------------------------------

FUNNEL_PCT = ("leads_all", "leads_taken", "leads_nd", "appointments_set", "appointments_cancelled",
              "appointments_issued", "quote_issued", "sale_sold", "sale_cancelled", "marketing_expenses")


def customer_funnel_pct(tables: Tables) -> DataFrame:
    """Each funnel row with its day's goal and that goal's percent of the year.

    ``date`` is the goal's, so it is NULL on days without one.
    """
    goals = tables("goal_by_date", "date", *[f"goal_{m}" for m in FUNNEL_PCT])
    totals = year_totals(goals, [f"goal_{m}" for m in FUNNEL_PCT], F.year("date"))
    shared = goals.join(totals, F.year("date") == c("_year"), "left").select(
        c("date").alias("goal_day"), *[f"goal_{m}" for m in FUNNEL_PCT],
        *[(ratio(f"goal_{m}", f"_total_goal_{m}") * 100).alias(f"pct_{m}") for m in FUNNEL_PCT])
    funnel = tables("customer_funnel", "date", *FUNNEL_PCT)
    joined = funnel.join(shared, c("date") == c("goal_day"), "left")
    return joined.select(c("goal_day").alias("date"), *FUNNEL_PCT,
                         *[f"goal_{m}" for m in FUNNEL_PCT], *[f"pct_{m}" for m in FUNNEL_PCT])


CARE_STEPS = [
    ("appointments_set", "leads_nd", "rate_set"),
    ("appointments_cancelled", "appointments_set", "rate_canceled"),
    ("appointments_issued_cc", "appointments_set", "rate_issued"),
]
FACT_COLUMNS = ("date", "type", "sale_rep", "product_category", "source_name", "source_type", "team_lead",
                "leads_taken", "leads_nd", "appointments_set", "appointments_cancelled",
                "appointments_issued_cc", "appointments_issued_sale", "quote_issued", "sold_total",
                "sale_sold", "sale_cancelled", "sale_cancelled_amount", "ads", "adl")


def _rate_rows(tables: Tables, *columns: str) -> DataFrame:
    return tables("yearly_goals", "type", *columns).where(ci_eq("type", RATE_ROW_TYPE))


def fact_table_goal(tables: Tables, as_of: date, after: date = SINCE) -> DataFrame:
    """Funnel goals per day and category, stacked on the staged actual funnel.

    Both goal streams are constant within a month, so they are joined by month
    and category; the days are written out afterwards.
    """
    rates = _rate_rows(tables, "leads_taken", "appointment_set", "appointment_canceled", "appointment_issued")
    expected = with_rates(tables("leads_nd_daily", "date", "leads_nd"), rates, {
        "rate_taken": "leads_taken", "rate_set": "appointment_set", "rate_canceled": "appointment_canceled",
        "rate_issued": "appointment_issued"})
    expected = expected.withColumn("leads_taken", F.round(ratio("leads_nd", c("rate_taken") / 100), 5))
    expected = funnel_chain(expected, "leads_nd", CARE_STEPS, digits=5)
    care = ("leads_taken", "leads_nd", "appointments_set", "appointments_cancelled", "appointments_issued_cc")
    months = expected.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(
        *[F.sum(m).alias(f"month_{m}") for m in care])
    share = dict(zip(care, ("leads_taken", "leads_nd", "appointment_set", "appointment_canceled",
                            "appointment_issued")))
    split = tables("product_yearly_goals", "year", "product_category", *share.values()).select(
        "year", "product_category", *[c(s).alias(f"share_{m}") for m, s in share.items()])
    care_goal = months.join(split, "year").select(
        "year", "month", "product_category", fold("product_category").alias("_category"),
        *[(c(f"month_{m}") * c(f"share_{m}") / month_days()).alias(m) for m in care])

    sales = {"appointments_issued_sale": "issued_unique", "quote_issued": "quoted", "sale_sold": "sold",
             "sale_cancelled": "canceled", "adl": "adl"}
    sales_goal = allocate_monthly(
        tables("goal_distribution", "year", "product_category", *sales.values()),
        tables("monthly_distribution", "year", "month", "sales_value"),
        {m: (g, "sales_value") for m, g in sales.items()}, keys=["product_category"],
    ).select("year", "month", fold("product_category").alias("_category"), *sales)
    goal = spread_days(care_goal.join(sales_goal, ["year", "month", "_category"]), after, year_end(as_of))

    unknown = {d: F.lit(None).cast("string") for d in ("sale_rep", "source_name", "source_type", "team_lead")}
    zeros = {m: F.lit(0.0) for m in ("sold_total", "sale_cancelled_amount", "ads")}
    goal = goal.withColumns({"type": F.lit("goal"), **unknown, **zeros}).select(*FACT_COLUMNS)
    return goal.unionByName(tables("stage_customer_funnel", *FACT_COLUMNS))


WBI_STEPS = [
    ("step_taken", "leads_nd", "rate_leads_nd"),
    ("step_set", "step_taken", "rate_set"),
    ("step_canceled", "step_set", "rate_canceled"),
    ("step_issued", "step_canceled", "rate_issued"),
    ("step_issued_sale", "step_issued", "rate_sales_issued"),
    ("step_quoted", "step_issued_sale", "rate_quoted"),
    ("step_sold", "step_quoted", "rate_sold"),
    ("step_sale_canceled", "step_sold", "rate_sale_canceled"),
]


def wbi_funnel_steps(tables: Tables, year: int) -> DataFrame:
    """Each funnel row of the year carried down the whole chain of rates, step on step."""
    rates = {"rate_leads_nd": "leads_nd", "rate_set": "appointment_set", "rate_canceled": "appointment_canceled",
             "rate_issued": "appointment_issued", "rate_sales_issued": "sales_issued", "rate_quoted": "quoted",
             "rate_sold": "sale_sold", "rate_sale_canceled": "sale_cancelled"}
    in_year = c("date").between(F.lit(date(year, 1, 1)), F.lit(date(year, 12, 31)))
    funnel = tables("stage_customer_funnel", "date", "leads_nd").where(in_year)
    chained = funnel_chain(with_rates(funnel, _rate_rows(tables, *rates.values()), rates), "leads_nd", WBI_STEPS)
    return chained.select("date", "leads_nd", *[s for s, _, _ in WBI_STEPS])


