"""Queries that load in several batches: what is kept up to date must equal what a full load gives."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce
from itertools import pairwise

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.functions.numbers import COUNT, MONEY
from leadflow.functions.text import ci_contains_any, ci_eq, ci_in, conform_name
from leadflow.operators import attribution, facts
from leadflow.operators.deltas import KeptSums, KeptTouches
from leadflow.operators.facts import Fact, Layout
from leadflow.plans import care, location, pipeline, sales
from leadflow.session import scratch_path, shuffles_dropped
from leadflow.sources import load, sheets, sinks
from leadflow.sources.silver import LAYOUTS, SilverTables, write_bucketed, write_silver_parts
from leadflow.sources.warehouse import FrameTables, Tables
from leadflow.streaming import upserts
from star_roles import AS_OF, CALENDAR_AFTER, StarRoles

c = F.col


def _saved(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# -- keyed tables by partition --------------------------------------------------

ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "price", "status"]


def _monthly_orders(t: StarRoles) -> DataFrame:
    """Orders by month; some have no month."""
    return t.raw("orders").select(
        c("o_orderkey").alias("id"), c("o_orderstatus").alias("status"), c("o_totalprice").cast(MONEY).alias("price"),
        F.when(c("o_orderkey") % 17 != 0, F.date_format("o_orderdate", "yyyy-MM")).alias("month"))


def _monthly_changes(t: StarRoles, status: str) -> DataFrame:
    """Line items of a status as changes to orders: most move to another month, some to none."""
    return t.raw("lineitem").where(c("l_linestatus") == status).select(
        c("l_orderkey").alias("id"), F.concat("l_returnflag", "l_linestatus").alias("status"),
        c("l_extendedprice").cast(MONEY).alias("price"),
        F.when(c("l_partkey") % 19 != 0, F.date_format("l_shipdate", "yyyy-MM")).alias("month"),
        "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey")


def upsert_partitions(t: StarRoles) -> DataFrame:
    """Two batches into orders by month; the side table says which months hold a batch's orders."""
    root = scratch_path(t.spark, "months")
    _monthly_orders(t).hint("rebalance", "month").write.partitionBy("month").parquet(f"{root}/orders")
    for number, status in enumerate("FO", 1):
        out = sinks.upsert_partitions(t.spark, f"{root}/orders", f"{root}/staged{number}", _monthly_changes(t, status), ["id"], ORDER,
                                      "month", f"{root}/places", number)
    return out


# -- sums and first touches kept by batches -----------------------------------------

_SALE = ("id", "sold_on", "canceled_date", "sold", "sold_price", "total_sales", "canceled", "canceled_amt", "sale_type", "department")
_VISIT = ("id", "start_on", "issued_unique", "category", "source_type", "appt_type", "rep_dept")


def _tenth(column: str = "id"):
    return F.substring_index(c(column), "-", 1).cast("bigint") % 10


def _nothing(tables: Tables, **roles: DataFrame) -> FrameTables:
    """The roles given, and of all others no row."""
    empty = {r: tables(r).limit(0) for r in ("sale", "appointment", "lead", "prospect") if r not in roles}
    return FrameTables(tables.spark, {**empty, **roles})


def kept_ads_adl(t: StarRoles) -> DataFrame:
    """ADS and ADL after three batches of changed, moved, canceled and new sales and changed visits."""
    root = scratch_path(t.spark, "kept-sales")
    kept = KeptSums(t.spark, f"{root}/sums", sales.ADS_ADL)
    state = {"sale": _saved(t("sale", *_SALE), f"{root}/sale0"), "appointment": _saved(t("appointment", *_VISIT), f"{root}/visit0")}
    kept.refresh(0, [], sales.ads_adl_rows(FrameTables(t.spark, state)))
    batches: list[tuple[str, Callable[[DataFrame], DataFrame]]] = [
        ("sale", lambda s: s.where(_tenth() == 1).withColumns({
            "total_sales": (c("total_sales") * 2).cast(MONEY), "sold_on": F.date_add("sold_on", 31)})),
        ("sale", lambda s: s.where(_tenth().isin(1, 2)).withColumns({
            "canceled": F.lit(True), "canceled_date": F.date_add("sold_on", 10), "canceled_amt": c("total_sales"),
            "department": F.when(c("id").like("%2"), "Service").otherwise(c("department"))})),
        ("appointment", lambda a: a.where(_tenth() == 4).withColumns({
            "start_on": F.date_add("start_on", 1), "issued_unique": c("issued_unique") + 1})),
        ("sale", lambda s: s.where(_tenth() == 3).withColumns({
            "id": F.concat("id", F.lit("-n")), "sold_on": F.date_sub("sold_on", 7)}).unionByName(
            s.where(_tenth() == 1).withColumn("sold_price", F.lit(None).cast(MONEY)))),
    ]
    for n, (role, change) in enumerate(batches, 1):
        old, new, state[role] = sinks.upsert_with_changes(state[role], change(state[role]), ["id"], ["id"], f"{root}/{role}{n}")
        kept.refresh(n, sales.ads_adl_rows(_nothing(t, **{role: old})), sales.ads_adl_rows(_nothing(t, **{role: new})))
        kept.fold(fan=2)
    return sales.ads_adl_kept(kept, AS_OF, CALENDAR_AFTER)


def kept_customer_care(t: StarRoles) -> DataFrame:
    """Customer care after prospects were turned away, leads changed and both came new: a prospect counts for all its leads."""
    root = scratch_path(t.spark, "kept-care")
    kept = KeptSums(t.spark, f"{root}/sums", care.CARE)
    leads = _saved(t("lead", "id", "prospect_id", "taken_on", "category", "source_type"), f"{root}/lead0")
    prospects = _saved(t("prospect", "id", "not_qualified_reason"), f"{root}/prospect0")
    kept.refresh(0, [], [care.lead_rows(FrameTables(t.spark, {"lead": leads, "prospect": prospects})), care.appointment_rows(t)])
    batches = [
        (leads.limit(0), prospects.where(_tenth().isin(3, 4)).withColumn("not_qualified_reason", F.lit("It is SPAM"))),
        (leads.where(_tenth().isin(3, 5)).withColumns({"taken_on": F.date_add("taken_on", 3), "category": F.lit("promo")}),
         prospects.limit(0)),
        (leads.where(_tenth() == 6).withColumns({"id": F.concat("id", F.lit("-n")), "prospect_id": F.concat("id", F.lit("-n"))}),
         prospects.where(_tenth() == 6).withColumns({"id": F.concat("id", F.lit("-n")), "not_qualified_reason": F.lit("out of AREA")})
         .unionByName(prospects.where(_tenth() == 0).withColumn("not_qualified_reason", F.lit(None).cast("string")))),
    ]
    for n, (lead_batch, prospect_batch) in enumerate(batches, 1):
        after = _saved(sinks.upsert_by_key(leads, lead_batch, ["id"], ["taken_on"]), f"{root}/lead{n}")
        known = _saved(sinks.upsert_by_key(prospects, prospect_batch, ["id"], ["id"]), f"{root}/prospect{n}")
        old, new = (care.lead_rows(FrameTables(t.spark, {
            "lead": care.affected_leads(of, lead_batch, prospect_batch), "prospect": by})) for of, by in ((leads, prospects), (after, known)))
        kept.refresh(n, [old], [new])
        leads, prospects = after, known
    kept.fold(whole=True)
    return care.customer_care_kept(kept, AS_OF, CALENDAR_AFTER)


def kept_first_touch(t: StarRoles) -> DataFrame:
    """First touches after appointments came, moved to a later day and went to another lead."""
    root = scratch_path(t.spark, "kept-touch")
    rows = _saved(t("appointment", "id", "lead_id", "set_on", "set_by"), f"{root}/0")
    number = c("id").cast("bigint")
    kept = KeptTouches(t.spark, f"{root}/touches")
    state = _saved(rows.where(number % 3 != 0), f"{root}/base")
    kept.refresh(0, None, state)
    batches = [rows.where(number % 3 == 0),
               rows.where(number % 7 == 3).withColumn("set_on", F.concat(F.lit("2009-"), F.substring("set_on", 6, 99))),
               rows.where(number % 5 == 1).withColumn("lead_id", F.concat(F.lit("x"), "lead_id"))]
    for n, batch in enumerate(batches, 1):
        old, new = sinks.changed_rows(state, batch, ["id"], ["set_on"])
        state = _saved(sinks.upsert_by_key(state, batch, ["id"], ["set_on"]), f"{root}/{n}")
        kept.refresh(n, old, new, state)
        kept.fold(fan=2)
    return kept.touches()


# -- a stream, folded ------------------------------------------------------------------

def stream_folds(t: StarRoles) -> DataFrame:
    """Changes to orders in six micro-batches, folded two by two in between."""
    root = scratch_path(t.spark, "folds")
    changes = t.raw("lineitem").select(
        c("l_orderkey").alias("id"), F.concat("l_returnflag", "l_linestatus").alias("status"),
        c("l_extendedprice").cast(MONEY).alias("price"), "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey")
    changes.repartition(6, "l_partkey").write.parquet(f"{root}/in")
    stream = t.spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    upserts.stream_upsert(stream, f"{root}/out", f"{root}/checkpoint", ["id"], ORDER).awaitTermination()
    upserts.fold(t.spark, f"{root}/out", ["id"], ORDER, fan=2)
    return upserts.current_rows(t.spark, f"{root}/out", ["id"], ORDER).select("id", "status", "price")


# -- runs ---------------------------------------------------------------------------------

def incremental_load(t: StarRoles) -> DataFrame:
    """Orders pulled three times, each time from the stored mark on; some come up to a month late."""
    spark, root = t.spark, scratch_path(t.spark, "pulls")
    orders = t.raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus", c("o_totalprice").cast(MONEY).alias("o_totalprice"), "o_orderdate")
    late = (c("o_orderdate") >= F.lit(datetime(1997, 12, 5))) & (c("o_orderkey") % 5 == 0)
    states = [orders.where((c("o_orderdate") <= F.lit(datetime(1997, 12, 31))) & ~late),
              orders.where(c("o_orderdate") <= F.lit(datetime(1999, 6, 30))), orders]
    order = pipeline.RawObject("orders", ("o_orderkey",), ("o_orderdate",), "o_orderdate", timedelta(days=31), "month",
                               "date_format(o_orderdate, 'yyyy-MM')")
    for n, state in enumerate(states, 1):
        state.write.parquet(f"{root}/source{n}")
        run = pipeline.Run(spark, root, f"r{n}", prefix=f"pull_{root[-32:]}_")
        pipeline.ingest(run, {"orders": load.Source("parquet", f"{root}/source{n}")}, [order])
    return spark.table(run.view("orders")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"), "month")


_ROLES = ("appointment", "marketing_source", "lead", "project", "prospect", "sale", "source_cost", "staff")
_DATES = {"appointment": "start_on", "sale": "sold_on", "lead": "taken_on", "project": "start_on"}


class PublishedStar(StarRoles):
    """The views that are only defined over the loaded tables, on what a run has published of these."""

    def __init__(self, published: Tables, folder: str):
        super().__init__(published.spark, folder)
        self._published = published

    def raw(self, table: str) -> DataFrame:
        return self._published(f"raw_{table}")

    def __call__(self, role: str, *columns: str) -> DataFrame:
        return self._published(role, *columns) if role in _ROLES else super().__call__(role, *columns)


def run_pipeline(t: StarRoles) -> DataFrame:
    """Two whole runs over all objects; the content of every published table.

    The second run finds changed sales (prices and months), new leads and a project week; goals of a sheet that has lost
    a year; and it pulls what is newer than its mark.
    """
    spark, root = t.spark, scratch_path(t.spark, "run")
    prefix = f"run_{root[-32:]}_"
    sources = {role: t(role) for role in _ROLES}
    sources["project_week_snapshot"] = t("project", "id", "status", "pct_complete").withColumn("week", F.lit(date(2001, 7, 30)))
    sources.update({f"raw_{table}": t.raw(table) for table in ("orders", "lineitem", "part")})
    keys = {role: ("id",) for role in _ROLES} | {"source_cost": None, "project_week_snapshot": ("id", "week"),
                                                 "raw_orders": ("o_orderkey",), "raw_lineitem": None, "raw_part": ("p_partkey",)}
    objects = [pipeline.RawObject(name, key, ("changed_on",), "changed_on", timedelta(days=1),
                                  *(("month", f"date_format({_DATES[name]}, 'yyyy')") if name == "sale" else ()))
               for name, key in keys.items()]
    crew = t.raw("orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count("*").alias("crew_worked"))
    shares = t("monthly_distribution", "year", "month", "value").groupBy("year").pivot("month", list(range(1, 13))).agg(F.first("value"))
    wide = shares.select(c("year").cast("string").alias("year"), *[c(str(m)).alias(f"m{m}") for m in range(1, 13)])
    first, second = datetime(2001, 7, 30), datetime(2001, 7, 31)
    states = {name: _saved(df.withColumn("changed_on", F.lit(first)), f"{root}/source1/{name}") for name, df in sources.items()}
    manifest = {name: load.Source("parquet", f"{root}/source1/{name}") for name in sources}
    later = {
        "sale": lambda s: s.where(_tenth() != 7).unionByName(s.where(_tenth() == 7).withColumns({
            "sold_on": F.date_add("sold_on", 400), "changed_on": F.lit(second)})),
        "lead": lambda a: a.unionByName(a.where(_tenth() == 2).withColumns({"id": F.concat("id", F.lit("-n")), "changed_on": F.lit(second)}))}
    for n in (1, 2):
        for name in later if n == 2 else ():
            later[name](states[name]).write.parquet(f"{root}/source2/{name}")
            manifest[name] = load.Source("parquet", f"{root}/source2/{name}")
        sheet = wide if n == 1 else wide.where("year < 2000").withColumn("m2", F.lit(None).cast("double")).withColumn("m1", c("m1") + 1)
        run = pipeline.Run(spark, root, f"r{n}", prefix=prefix)
        names = pipeline.run_pipeline(run, manifest, objects, {"monthly_distribution": sheets.monthly_goals({"value": sheet})}, t,
                                      date(2001, 7, 29 + n), crew, views=lambda published: PublishedStar(published, t.folder))
    out = [_content(name, spark.table(run.view(name))) for name in names]
    rows = out[0]
    for more in out[1:]:
        rows = rows.unionByName(more)
    return rows


def _content(name: str, df: DataFrame) -> DataFrame:
    """Rows of a table and a checksum over all their cells."""
    def text(f: str, kind: str):
        if "decimal" in kind or kind == "double":
            return F.round(c(f).cast("decimal(30,8)"), 4).cast("decimal(28,4)").cast("string")
        return c(f).cast("string")
    cells = [F.coalesce(text(f, kind), F.lit("~")) for f, kind in df.dtypes
             if f not in ("changed_on", "month") or (name, f) == ("monthly_distribution", "month")]
    digest = F.conv(F.substring(F.md5(F.concat_ws("|", *cells).cast("binary")), 1, 8), 16, 10).cast("bigint")
    return df.agg(F.count("*").alias("row_count"), F.sum(digest).alias("content")).select(F.lit(name).alias("table_name"), "row_count", "content")


# -- silver tables ---------------------------------------------------------------------------

def silver(t: StarRoles, buckets: int = 8) -> SilverTables:
    """The raw tables of the customer care jobs in their silver layout."""
    root = scratch_path(t.spark, "silver")
    prefix = f"silver_{root[-32:]}_"
    for role in ("appointment", "sale"):
        write_silver_parts(t.parts(role), f"{root}/{role}", LAYOUTS[role])
    for role in ("lead", "prospect"):
        with shuffles_dropped(t.spark):
            write_bucketed(t(role), f"{prefix}{role}", f"{root}/{role}", role, buckets)
    return SilverTables(t.spark, root, prefix, t, {"appointment": "folder", "sale": "folder", "lead": "bucketed", "prospect": "bucketed"})


def silver_customer_care(t: StarRoles) -> DataFrame:
    return care.customer_care(silver(t), AS_OF, CALENDAR_AFTER)


def silver_customer_care_v2(t: StarRoles) -> DataFrame:
    return care.customer_care_by_staff(silver(t), AS_OF)


def silver_staff_location(t: StarRoles) -> DataFrame:
    """With much input, ranges of days one after the other: each is complete in itself, and on disk are the shuffle files of
    one at a time."""
    tables, n = silver(t), min(4, t.n_parts("sale"))
    if n == 1:
        return location.staff_location(tables, AS_OF, CALENDAR_AFTER)
    root = scratch_path(t.spark, "places")
    edges = [CALENDAR_AFTER + (AS_OF - CALENDAR_AFTER) * i // n for i in range(n + 1)]
    out = []
    for after, through in pairwise(edges):
        with shuffles_dropped(t.spark):
            out.append(_saved(location.staff_location(tables, through, after), f"{root}/{through}"))
    return reduce(DataFrame.unionByName, out)


# -- spellings, sheets --------------------------------------------------------------------

_SPELLINGS = "element_at(array('José', 'JOSE', 'jose', 'Jose\u0301', ' Zoë ', 'ZOE', 'Ñandú', 'nandu'), cast({} % 8 + 1 as int))"


def folded_names(t: StarRoles) -> DataFrame:
    """People spelled with and without accents: tests, groups, lookups and daily facts take them for one."""
    people = t.raw("customer").selectExpr("c_custkey", f"{_SPELLINGS.format('c_custkey')} as name",
                                          "date_add(date'1999-01-01', cast(c_custkey % 5 as int)) as day")
    layout = Layout({"staff": "string"}, {"n": COUNT, "zoe": COUNT, "named_in": COUNT, "holds": COUNT})
    rows = facts.fact_rows(people, [Fact(c("day"), {"staff": conform_name("name")}, {
        "n": F.lit(1), "zoe": ci_eq(F.trim("name"), "Zoé").cast("int"), "named_in": ci_in("name", ["JOSÉ", "ñandu"]).cast("int"),
        "holds": ci_contains_any("name", ["ándú"]).cast("int")})], layout)
    sums = facts.daily_facts([rows], layout)
    teams = t.raw("customer").selectExpr("element_at(array('JOSÉ', 'zoë', 'Nandu'), cast(c_custkey % 3 + 1 as int)) as who",
                                         "concat('Team ', c_custkey % 3) as team").distinct()
    return attribution.lookup_default(sums, teams, "staff", "who", {"team": "team"}, {"team": "none"})


def sheet_end(t: StarRoles) -> DataFrame:
    """A sheet of order months read from its file: what stands below the first row without a year is not goals."""
    root = scratch_path(t.spark, "sheet")
    o = t.raw("orders")
    cells = [F.sum(F.when(F.month("o_orderdate") == m, c("o_totalprice").cast(MONEY))).cast("double").alias(f"m{m}") for m in range(1, 13)]
    years = o.groupBy(F.year("o_orderdate").alias("y")).agg(*cells)
    # three years, a line of text, the rest: in one file, in this order
    placed = years.select("*", F.when(c("y") < 1998, c("y")).otherwise(c("y") + 1).alias("place")).unionByName(
        years.where("y = 1998").withColumns({"place": F.lit(1998), "y": F.lit(None).cast("int")}))
    placed.select(F.coalesce(c("y").cast("string"), F.lit("Below: last plan")).alias("year"), *[f"m{m}" for m in range(1, 13)], "place") \
        .coalesce(1).sortWithinPartitions("place").drop("place").write.option("header", True).csv(f"{root}/csv")
    out = [sheets.unpivot_months(sheets.sheet_rows(t.spark, f"{root}/csv"), "value").withColumn("file", F.lit("csv"))]
    t.spark.read.option("header", True).csv(f"{root}/csv").write.parquet(f"{root}/parquet")
    out.append(sheets.unpivot_months(sheets.sheet_rows(t.spark, f"{root}/parquet", "parquet"), "value").withColumn("file", F.lit("parquet")))
    return out[0].unionByName(out[1])


def load_queries() -> dict[str, Callable[[StarRoles], DataFrame]]:
    return {
        "upsert_partitions": upsert_partitions, "kept_ads_adl": kept_ads_adl, "kept_customer_care": kept_customer_care,
        "kept_first_touch": kept_first_touch, "stream_folds": stream_folds, "incremental_load": incremental_load,
        "run_pipeline": run_pipeline, "silver_customer_care": silver_customer_care,
        "silver_customer_care_v2": silver_customer_care_v2, "silver_staff_location": silver_staff_location, "folded_names": folded_names, "sheet_end": sheet_end,
    }
