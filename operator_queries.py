"""One query per reusable operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.functions.fixed_values import NON_SALES_SOURCES, SERVICE_CATEGORY
from leadflow.functions.numbers import COUNT, MONEY, ratio, safe_ratio
from leadflow.functions.text import (
    ci_eq, ci_in, ci_ne, ci_not_in, conform_name, disqualified, to_day,
)
from leadflow.operators import attribution, calendar, facts, goals, marketing
from leadflow.operators.facts import Fact, Layout
from leadflow.plans import production, stage
from leadflow.plans import sales as sales_plans
from leadflow.session import scratch_path
from leadflow.sources import load, sheets, sinks
from star_roles import AS_OF, CALENDAR_AFTER, StarRoles
from leadflow.streaming import funnel as stream_funnel
from leadflow.streaming import upserts

c = F.col


def _folder(t: StarRoles, table: str) -> str:
    return f"{t.folder}/{table}.parquet"


# -- sources ------------------------------------------------------------------

def src_load_object(t):
    manifest = {"order": load.Source("parquet", _folder(t, "orders"))}
    return load.load_object(t.spark, manifest, "order").withColumn("o_orderdate", F.to_date("o_orderdate"))


def conform_types(t):
    df = load.conform_types(t.raw("part").withColumn("sizes", F.array("p_size", F.lit(1))))
    return df.withColumn("type_of_size", F.typeof("p_size"))


def nan_to_null(t):
    spoiled = t.raw("events").select(
        "event_id", "event_type",
        F.when(c("event_type") == "error", F.lit(float("nan"))).otherwise(c("value")).alias("value"))
    return load.nan_to_null(spoiled)


def incremental_pull(t):
    orders = t.raw("orders").select("o_orderkey", "o_orderdate")
    return load.incremental_pull(orders, "o_orderdate", "2000-06-15 00:00:00").withColumn(
        "o_orderdate", F.to_date("o_orderdate"))


def _wide_months(t, measure):
    """Order months as a sheet: a row per year and one for all years, headed by a text."""
    o = t.raw("orders")
    cells = [F.sum(F.when(F.month("o_orderdate") == m, measure)).cast("double").alias(f"m{m}") for m in range(1, 13)]
    by_year = o.groupBy(F.year("o_orderdate").cast("string").alias("year")).agg(*cells)
    return by_year.unionByName(o.groupBy(F.lit("All years").alias("year")).agg(*cells))


def unpivot_monthly_share(t):
    return sheets.unpivot_months(_wide_months(t, c("o_totalprice").cast(MONEY) / 7), "value")


def merge_monthly_shares(t):
    urgent = F.when(c("o_orderpriority") == "1-URGENT", F.lit(1))
    return sheets.merge_share_columns({
        "sales_value": sheets.unpivot_months(_wide_months(t, c("o_totalprice").cast(MONEY)), "sales_value"),
        "prod_sale": sheets.unpivot_months(_wide_months(t, F.lit(1)), "prod_sale"),
        "service_sale": sheets.unpivot_months(_wide_months(t, urgent), "service_sale"),
    })


_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def _goal_sheet(t, measure):
    lines = t.raw("lineitem").join(t.raw("part"), c("l_partkey") == c("p_partkey"))
    cells = {f"{p.lower()}_{s.lower()}": (c("p_type") == p) & (c("l_linestatus") == s) for p in _TYPES for s in "FO"}
    return lines.groupBy(F.year("l_shipdate").alias("year")).agg(
        *[F.sum(F.when(cond, measure)).cast("double").alias(name) for name, cond in cells.items()])


def _goal_header(t):
    """Column heads from the part types: ``F`` columns name a person, ``O`` columns do not."""
    types = t.raw("part").select("p_type").distinct()
    return types.select(
        F.explode(F.array(F.lit("F"), F.lit("O"))).alias("s"), "p_type").select(
        F.lower(F.concat_ws("_", "p_type", "s")).alias("col_id"), c("p_type").alias("category"),
        F.when(c("s") == "F", F.concat(F.lit("Crew "), "p_type")).otherwise(F.lit("")).alias("name"))


def unpivot_goals(t):
    header = _goal_header(t)
    sold = sheets.unpivot_goal_headers(_goal_sheet(t, F.lit(1)), header, "sold")
    net = sheets.unpivot_goal_headers(_goal_sheet(t, c("l_extendedprice").cast(MONEY)), header, "net")
    both = {"sold": sold, "net": net}
    return sheets.merge_goal_metrics(both, named=True).unionByName(
        sheets.merge_goal_metrics(both, named=False), allowMissingColumns=True)


def load_pairs(t):
    people = t.raw("customer").select(
        F.when(c("c_mktsegment") == "FURNITURE", F.lit("")).otherwise(c("c_mktsegment")).alias("team"),
        F.when(c("c_custkey") % 7 == 0, None).otherwise(F.concat(F.lit("Rep "), (c("c_custkey") % 40).cast("string")))
        .alias("employee"))
    return sheets.load_pairs(people, "team", "employee")


def kpi_cells_snapshot(t):
    cells = t.raw("orders").agg(
        (F.sum(F.when(c("o_orderstatus") == "F", 1).otherwise(0)) / F.count("*")).alias("sales_pct"),
        F.sum(c("o_totalprice").cast(MONEY)).cast("string").alias("net_sales"),
        F.lit(None).cast("string").alias("production_pct"))
    done = sheets.kpi_cells(cells, ["sales_pct", "net_sales", "production_pct"], datetime(2001, 8, 1, 6, 30))
    return done.withColumn("created", F.date_format("created", "yyyy-MM-dd HH:mm"))


def to_day_query(t):
    return t("appointment", "id", "set_on").select("id", to_day("set_on").alias("day"))


def calendar_query(t):
    """Orders on every day up to the last one on record."""
    orders = t.raw("orders")
    last = orders.agg(F.to_date(F.max("o_orderdate")).alias("d")).scalar()
    days = calendar.calendar(t.spark, CALENDAR_AFTER, last)
    counts = orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count("*").alias("orders"))
    return days.join(counts, "date", "left")


# -- sinks --------------------------------------------------------------------

_NEWEST = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "price", "status"]


def _updates(t):
    """Line items as changes to orders: several per order, some prices missing, some new orders."""
    return t.raw("lineitem").select(
        F.when(c("l_linenumber") == 7, c("l_orderkey") + 1000000000).otherwise(c("l_orderkey")).alias("id"),
        F.concat("l_returnflag", "l_linestatus").alias("status"),
        F.when(c("l_returnflag") == "R", None).otherwise(c("l_extendedprice").cast(MONEY)).alias("price"),
        "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey")


def _target(t):
    return t.raw("orders").select(c("o_orderkey").alias("id"), c("o_orderstatus").alias("status"),
                                  c("o_totalprice").cast(MONEY).alias("price"))


def upsert_by_key(t):
    return sinks.upsert_by_key(_target(t), _updates(t), ["id"], _NEWEST)


def insert_ignore(t):
    return sinks.insert_ignore(_updates(t), ["id"], _NEWEST, _target(t))


def upsert_column(t):
    fresh = sinks.latest_per_key(_updates(t), ["id"], _NEWEST).select("id", "price")
    return sinks.upsert_column(_target(t), fresh, ["id"], "price")


def update_if_changed(t):
    days = t.raw("orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.count("*").alias("crew_worked"))
    shipped = t.raw("lineitem").groupBy(F.to_date("l_shipdate").alias("date")).agg(
        F.countDistinct("l_orderkey").alias("n")).select(
        "date", F.when(c("n") % 5 == 0, None).otherwise(F.floor(c("n") / 4)).alias("crew_worked"))
    return sinks.update_if_changed(days, shipped, ["date"], "crew_worked")


def snapshot_replace(t):
    """Publish, publish again, then offer an empty result, which must not replace the second."""
    spark, root = t.spark, scratch_path(t.spark, "snapshot")
    view = f"snapshot_{root[-32:]}"
    target = _target(t)
    sinks.snapshot_replace(spark, target, view, f"{root}/1")
    sinks.snapshot_replace(spark, target.where(c("status") != "P"), view, f"{root}/2")
    return sinks.snapshot_replace(spark, target.where(c("id") < 0), view, f"{root}/3")


def stage_cast(t):
    return sinks.stage_cast(t("appointment", "id", "set_on", "zip", "issued"), [
        ("date", "set_on", "date"), ("id", "id", "bigint"), ("zip", "zip", "double"), ("issued", "issued", "double")])


def vtc_daily_snapshot(t):
    history = t.raw("orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.sum(c("o_totalprice").cast(MONEY)).cast(MONEY).alias("vtc"))
    return stage.vtc_daily_snapshot(t, date(2001, 7, 31), history)


# -- text rules, joins --------------------------------------------------------

def ci_filter(t):
    a = t("appointment", "category", "source_type", "appt_type")
    tests = {
        "is_in": ci_in("source_type", NON_SALES_SOURCES),
        "not_in": ci_not_in("source_type", NON_SALES_SOURCES),
        "not_in_or_null": ci_not_in("source_type", NON_SALES_SOURCES, keep_null=True),
        "not_equal": ci_ne("category", SERVICE_CATEGORY),
        "not_equal_or_null": ci_ne("category", SERVICE_CATEGORY, keep_null=True),
        "equal": ci_eq("category", "economy"),
    }
    return a.groupBy("appt_type").agg(*[F.count_if(e).alias(n) for n, e in tests.items()])


def disqualified_query(t):
    return t("prospect", "not_qualified_reason").groupBy("not_qualified_reason").agg(
        F.count("*").alias("prospects"), F.count_if(disqualified("not_qualified_reason")).alias("turned_away"))


def conform_name_query(t):
    return t("appointment", "rep").groupBy(conform_name("rep").alias("staff")).agg(F.count("*").alias("n"))


def calendar_left(t):
    layout = Layout({"product_category": "string"}, {"set_count": COUNT})
    rows = facts.fact_rows(
        t("appointment", "set_on", "category"),
        [Fact(to_day("set_on"), {"product_category": c("category")}, {"set_count": F.lit(1)})], layout)
    return facts.calendar_left(facts.fact_union([rows], layout), layout, date(1997, 1, 10), date(2000, 1, 20))


def lookup_default(t):
    by_id = t("appointment", "set_by").groupBy("set_by").agg(F.count("*").alias("n"))
    return attribution.lookup_default(by_id, t("staff", "id", "name", "team_lead"), "set_by", "id",
                                      {"name": "name", "team_lead": "team_lead"}, {"name": "Unassigned"})


def leads_qualified(t):
    return attribution.leads_qualified(t("lead", "id", "prospect_id", "taken_on"),
                                       t("prospect", "id", "not_qualified_reason"))


def semi_category(t):
    counts = t("appointment", "category", "start_on").groupBy(c("category").alias("product_category")).agg(
        F.count("*").alias("n"))
    return sales_plans.semi_category(counts, t("sale", "category"))


def full_outer_cost_leads(t):
    """All leads (not only qualified ones) beside the cost of the last days."""
    layout = Layout({"source_type": "string"}, {"leads_nd": COUNT})
    span = (date(1999, 1, 5), date(1999, 6, 30))
    leads = facts.daily_facts([facts.fact_rows(
        t("lead", "taken_on", "source_type"),
        [Fact(c("taken_on"), {"source_type": c("source_type")}, {"leads_nd": F.lit(1)})], layout, span)], layout, span)
    cost = t("source_cost", "paid_on", "marketing_source_id", "amount").groupBy(
        c("paid_on").alias("date"),
        F.when(c("marketing_source_id").cast("bigint") % 2 == 0, "Building").otherwise("household").alias("source_type"),
    ).agg(F.sum("amount").alias("total_cost"))
    return marketing.full_outer_cost_leads(leads, cost, *span)


def first_touch(t):
    return attribution.first_touch(t("appointment", "id", "lead_id", "set_on", "set_by").where(
        to_day("set_on").isNotNull()))


# -- goals ---------------------------------------------------------------------

def goal_allocate_daily(t):
    return goals.allocate_daily(
        t("goal_distribution", "year", "product_category", "net"), t("monthly_distribution", "year", "month", "sales_value"),
        {"net": ("net", "sales_value")}, CALENDAR_AFTER, date(2001, 12, 31), keys=["product_category"])


def goal_even_split(t):
    return goals.even_split_daily(t("product_yearly_goals", "year", "product_category", "prod"), {"prod": "prod"},
                                  CALENDAR_AFTER, date(2001, 12, 31), keys=["product_category"])


def _monthly_orders(t):
    return t.raw("orders").groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(
        F.sum(c("o_totalprice").cast(MONEY)).cast("double").alias("amount"),
        F.count("*").cast("double").alias("orders"))


def trailing_mean(t):
    return goals.trailing_mean(_monthly_orders(t), ["amount", "orders"])


def share_of_year(t):
    return goals.share_of_year(_monthly_orders(t), {"amount_pct": "amount", "orders_pct": "orders"}, c("year"))


def seasonal_share(t):
    through = date(2001, 12, 31)
    actual = sales_plans.sale_prod_service_actual(t, CALENDAR_AFTER, through)
    monthly = actual.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(
        *[F.sum(m).cast("double").alias(m) for m in ("prod", "service", "std")])
    return goals.seasonal_share(monthly, ["prod", "service", "std"])


def funnel_chain(t):
    rates = t("yearly_goals", "type", "appointment_set", "quoted", "sale_sold").where(ci_eq("type", "wbi_goal"))
    df = goals.with_rates(t("leads_nd_daily", "date", "leads_nd"), rates,
                          {"r_set": "appointment_set", "r_quoted": "quoted", "r_sold": "sale_sold"})
    chained = goals.funnel_chain(df, "leads_nd", [
        ("set_count", "leads_nd", "r_set"), ("quoted", "set_count", "r_quoted"), ("sold", "set_count", "r_sold")], digits=5)
    return chained.select("date", "leads_nd", "set_count", "quoted", "sold")


def fact_union(t):
    layout = Layout({"staff": "string"}, {"sold": COUNT, "earned": MONEY})
    rows = [
        facts.fact_rows(t("sale", "sold_on", "rep", "sold"),
                        [Fact(c("sold_on"), {"staff": c("rep")}, {"sold": c("sold")})], layout),
        facts.fact_rows(t("project", "start_on", "rep", "value_earned"),
                        [Fact(c("start_on"), {"staff": c("rep")}, {"earned": c("value_earned")})], layout),
    ]
    return facts.daily_facts(rows, layout)


def safe_ratio_query(t):
    sums = t("appointment", "start_on", "issued", "sold").groupBy("start_on").agg(
        F.sum("sold").alias("sold"), F.sum("issued").alias("issued"))
    return sums.select(c("start_on").alias("date"), safe_ratio("sold", "issued").alias("guarded"),
                       ratio("sold", "issued").alias("plain"))


def stack_actual_goal(t):
    orders = _monthly_orders(t)
    lines = t.raw("lineitem").groupBy(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")).agg(
        F.sum(c("l_extendedprice").cast(MONEY)).cast("double").alias("amount"))
    return goals.stack_actual_goal(orders.select("year", "month", "amount"), lines)


# -- streams, pipeline -----------------------------------------------------------

def _stream(t, table):
    schema = t.raw(table).schema
    return t.spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet").parquet(t.folder)


def stream_upsert(t):
    """The changes of ``upsert_by_key`` as a stream, on top of the same orders."""
    root = scratch_path(t.spark, "upsert")
    source = StreamRoles(t)
    query = upserts.stream_upsert(_updates(source), f"{root}/changes", f"{root}/checkpoint", ["id"], _NEWEST)
    query.awaitTermination()
    base = _target(t)
    for name in _NEWEST[:4]:
        base = base.withColumn(name, F.lit(None).cast(dict(t.raw("lineitem").dtypes)[name]))
    return upserts.current_rows(t.spark, f"{root}/changes", ["id"], _NEWEST, base).select("id", "status", "price")


class StreamRoles:
    """Raw tables as streams."""

    def __init__(self, t: StarRoles):
        self._t = t

    def raw(self, table: str) -> DataFrame:
        return _stream(self._t, table)


def stream_daily_funnel(t):
    root = scratch_path(t.spark, "funnel")
    is_a = lambda kind: F.when(c("event_type") == kind, 1).otherwise(0)
    funnel = stream_funnel.daily_funnel(
        _stream(t, "events").withColumn("category", (c("event_id") % 7).cast("string"))
        .withColumn("ts", c("ts").cast("timestamp")),
        "ts", ["category"], {"leads": is_a("signup"), "visits": is_a("view"), "sold": is_a("purchase")})
    stream_funnel.stream_daily_funnel(funnel, f"{root}/days", f"{root}/checkpoint").awaitTermination()
    return upserts.current_rows(t.spark, f"{root}/days", ["date", "category"], ["seq"]).drop("seq")


def operator_queries() -> dict[str, Callable[[StarRoles], DataFrame]]:
    return {
        "src_load_object": src_load_object, "conform_types": conform_types, "nan_to_null": nan_to_null,
        "incremental_pull": incremental_pull, "unpivot_monthly_share": unpivot_monthly_share,
        "merge_monthly_shares": merge_monthly_shares, "unpivot_goals": unpivot_goals, "load_pairs": load_pairs,
        "kpi_cells_snapshot": kpi_cells_snapshot, "to_day": to_day_query, "calendar": calendar_query,
        "upsert_by_key": upsert_by_key, "snapshot_replace": snapshot_replace, "insert_ignore": insert_ignore,
        "upsert_column": upsert_column, "update_if_changed": update_if_changed,
        "vtc_daily_snapshot": vtc_daily_snapshot, "stage_cast": stage_cast,
        "ci_filter": ci_filter, "disqualified": disqualified_query, "conform_name": conform_name_query,
        "calendar_left": calendar_left, "lookup_default": lookup_default, "leads_qualified": leads_qualified,
        "semi_category": semi_category, "full_outer_cost_leads": full_outer_cost_leads, "first_touch": first_touch,
        "goal_allocate_daily": goal_allocate_daily, "goal_even_split": goal_even_split,
        "trailing_mean": trailing_mean, "share_of_year": share_of_year, "seasonal_share": seasonal_share,
        "funnel_chain": funnel_chain, "fact_union": fact_union, "safe_ratio": safe_ratio_query,
        "stack_actual_goal": stack_actual_goal,
        "stage_actual_prod_cat": stage.stage_actual_prod_cat, "stage_actual_goal_date": stage.stage_actual_goal_date,
        "stage_customer_funnel": stage.stage_customer_funnel,
        "stage_customer_funnel_goal": stage.stage_customer_funnel_goal,
        "vtc_today": lambda t: production.vtc_today(t, AS_OF),
        "stream_upsert": stream_upsert, "stream_daily_funnel": stream_daily_funnel,
    }
