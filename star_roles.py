"""The KPI roles (sale, appointment, lead, ...) seen through a star schema.

Maps the order/lineitem/event tables onto the roles the KPI jobs read, so that
the jobs can run on them.  Whole tables are mapped; nothing is filtered away.
A role is described by its base table, the parent tables its columns need and
one expression per column; only parents of the requested columns are joined.
Joins are left joins to unique keys, so leaving one out never changes the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadflow.functions.numbers import MONEY

AS_OF = date(2001, 8, 1)
CALENDAR_AFTER = date(1994, 12, 31)
FISCAL_YEAR = 1999

Parents = dict[str, Callable[[DataFrame], DataFrame]]
Columns = dict[str, tuple[str, str]]

# Day shift that brings the event month (January 2024) to January 1999; users
# are then spread over the Januaries of 1995 to 2001.
EVENT_DAY = "date_add(to_date(ts), cast((user_id % 7 - 4) * 365 - 9131 as int))"
LEAD_DAY = ("case when c_custkey % 101 = 0 then null else "
            "date_add(date'1999-01-01', cast((c_custkey % 30) + (c_custkey % 7 - 4) * 365 as int)) end")
SOURCE_TYPE = ("case c_mktsegment when 'MACHINERY' then 'Existing Database' "
               "when 'FURNITURE' then null else c_mktsegment end")


def _category(key: str) -> str:
    return (f"case {key} % 7 when 0 then null when 1 then 'service work' when 2 then 'Service' "
            f"when 3 then 'ECONOMY' when 4 then 'Economy' when 5 then 'PROMO' else '' end")


SALE: Columns = {
    "id": ("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, unix_date(to_date(l_shipdate)), "
           "cast(l_quantity as int))", ""),
    "sold_on": ("case when l_returnflag = 'R' and o_orderstatus = 'P' then null else to_date(o_orderdate) end", "o"),
    "canceled": ("l_returnflag = 'R'", ""),
    "canceled_date": ("case when l_returnflag = 'R' then to_date(l_shipdate) end", ""),
    "canceled_amt": (f"case when l_returnflag = 'R' then cast(l_extendedprice as {MONEY}) end", ""),
    "total_sales": (f"cast(l_extendedprice as {MONEY})", ""),
    "sold_price": (f"cast(l_extendedprice * (1 - l_discount) as {MONEY})", ""),
    "orig_price": (f"cast(l_extendedprice * (1 + l_tax) as {MONEY})", ""),
    "net_sales": (f"cast(l_extendedprice * (1 - l_discount) as {MONEY})", ""),
    "sold": ("1", ""),
    "category": ("p_type", "p"),
    "rep": ("case when l_linenumber % 2 = 0 then upper(s_name) else s_name end", "s"),
    "sale_type": ("case o_orderpriority when '1-URGENT' then 'Service Opportunity' "
                  "when '5-LOW' then 'annual maintenance' when '4-NOT SPECIFIED' then null "
                  "else 'Standard' end", "o"),
    "department": ("case when o_orderstatus = 'O' then 'Service' else 'Sales' end", "o"),
    "appt_type": ("case l_linenumber when 1 then 'New' when 2 then 'reset' when 3 then 'Rehash' "
                  "when 4 then 'Radon CRM Pickup' when 5 then null else 'WCC' end", ""),
    "foreman_sale_date": ("case when l_linestatus = 'F' then to_date(l_shipdate) end", ""),
    "foreman_basis": (f"cast(l_extendedprice * l_discount as {MONEY})", ""),
    "completed_by_dept": ("case when l_linestatus = 'F' then 'Service Dept.' "
                          "when l_returnflag = 'N' then null else 'Production Dept.' end", ""),
    "completed_by_foreman": ("s_name", "s"),
    "city": ("n_name", "ocn"),
    "state": ("r_name", "ocnr"),
    "zip": ("cast(o_custkey % 100 as string)", "o"),
    "address": ("c_name", "oc"),
}

APPOINTMENT: Columns = {
    "id": ("cast(event_id as string)", ""),
    "lead_id": ("case when event_id % 13 = 0 then null else cast(user_id as string) end", ""),
    "start_on": (EVENT_DAY, ""),
    "set_on": (f"case event_id % 97 when 0 then '' when 1 then 'not a date' when 2 then null else "
               f"concat(cast({EVENT_DAY} as string), 'T', date_format(ts, 'HH:mm:ss')) end", ""),
    "canceled_on": (f"case when event_id % 5 = 0 then "
                    f"concat(cast(date_add({EVENT_DAY}, 1) as string), 'T', date_format(ts, 'HH:mm:ss')) end", ""),
    "canceled": ("event_id % 10 = 0", ""),
    "appt_type": ("case event_type when 'signup' then 'New' when 'view' then 'Reset' "
                  "when 'click' then 'rehash' when 'error' then 'Radon CRM Pickup' else 'WCC' end", ""),
    "category": (_category("event_id"), ""),
    "source_type": (SOURCE_TYPE, "c"),
    "rep": ("case when user_id % 2 = 0 then concat(' Supplier#', lpad(cast(user_id % 100 as string), 9, '0')) "
            "else concat('SUPPLIER#', lpad(cast(user_id % 100 as string), 9, '0')) end", ""),
    "rep_consolidated": ("concat('Supplier#', lpad(cast(user_id % 100 as string), 9, '0'))", ""),
    "rep_dept": ("case event_id % 4 when 0 then 'Service' when 1 then 'SALES' else 'Sales' end", ""),
    "set_by": ("case when event_id % 7 = 0 then null else cast(user_id % 120 as string) end", ""),
    "team_lead": ("concat(case when event_id % 2 = 0 then 'Lead ' else 'LEAD ' end, cast(user_id % 5 as string))", ""),
    "issued": ("case when event_id % 11 = 0 then null else cast(event_id % 3 as int) end", ""),
    "issued_unique": ("cast(least(event_id % 3, 1) as int)", ""),
    "quoted": ("cast(event_id % 2 as int)", ""),
    "sold": ("case when event_id % 4 = 0 then 1 else 0 end", ""),
    "city": ("n_name", "cn"),
    "state": ("r_name", "cnr"),
    "zip": ("cast(user_id % 100 as string)", ""),
    "address": ("c_name", "c"),
}

LEAD: Columns = {
    "id": ("cast(c_custkey as string)", ""),
    "prospect_id": ("case when c_custkey % 11 = 0 then null when c_custkey % 13 = 0 "
                    "then cast(c_custkey + 1000000000 as string) else cast(c_custkey as string) end", ""),
    "taken_on": (LEAD_DAY, ""),
    "category": (_category("c_custkey"), ""),
    "source_type": (SOURCE_TYPE, ""),
}

PROSPECT: Columns = {
    "id": ("cast(c_custkey as string)", ""),
    "not_qualified_reason": ("case c_custkey % 8 when 0 then 'SPAM call' when 1 then 'Out of area' "
                             "when 2 then 'old: bad or old DATA' when 3 then 'Price' else null end", ""),
}

STAFF: Columns = {
    "id": ("cast(s_suppkey as string)", ""),
    "name": ("s_name", ""),
    "team_lead": ("n_name", "n"),
    "start_on": ("date_add(date'1994-06-01', cast(s_suppkey % 2000 as int))", ""),
    "title": ("case s_suppkey % 4 when 0 then 'Manager' when 1 then 'manager' when 2 then 'Installer' end", ""),
}

PROJECT: Columns = {
    "id": ("cast(o_orderkey as string)", ""),
    "start_on": ("to_date(o_orderdate)", ""),
    "sold_on": ("to_date(o_orderdate)", ""),
    "completed_on": ("case when o_orderstatus = 'F' then to_date(last_ship) end", "l"),
    "status": ("case o_orderstatus when 'P' then 'Canceled' when 'O' then 'Active' "
               "else case when o_orderkey % 3 = 0 then 'active' else 'Completed' end end", ""),
    "job_type": ("case o_orderpriority when '5-LOW' then '021 - SERVICE work' "
                 "when '4-NOT SPECIFIED' then null else '010 - Install' end", ""),
    "pct_complete": ("100.0D * closed_lines / order_lines", "l"),
    "value_earned": (f"cast(quantity as {MONEY})", "l"),
    "value_to_complete": (f"cast(open_amount as {MONEY})", "l"),
    "category": ("o_orderpriority", ""),
    "foreman": ("concat('Foreman ', cast(first_supplier % 50 as string))", "l"),
    "rep": ("concat('Supplier#', lpad(cast(first_supplier as string), 9, '0'))", "l"),
    "city": ("n_name", "cn"),
    "state": ("r_name", "cnr"),
    "zip": ("cast(o_custkey % 100 as string)", ""),
    "address": ("c_name", "c"),
}

SOURCE_COST: Columns = {
    "name": ("s_name", "s"),
    "marketing_source_id": ("cast(l_suppkey as string)", ""),
    "category": ("p_type", "p"),
    "paid_on": ("to_date(l_shipdate)", ""),
    "amount": (f"cast(l_extendedprice * l_tax as {MONEY})", ""),
}

MARKETING_SOURCE: Columns = {
    "id": ("cast(s_suppkey as string)", ""),
    "source_type": ("case s_suppkey % 5 when 0 then 'Building' when 1 then 'AUTOMOBILE' "
                    "when 2 then 'HOUSEHOLD' when 3 then 'TV' end", ""),
}


#: Roles that are built part by part: the base table, the column that splits it (the key of its largest parent).
SPLIT = {"sale": ("lineitem", "l_orderkey"), "appointment": ("events", "user_id")}
PART_BYTES, PARTS = 8 << 20, 8  # of the base table, and how many parts at most


class StarRoles:
    """``tables(role, *columns)`` over a folder of star-schema Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._schemas: dict[str, T.StructType] = {}

    def raw(self, table: str) -> DataFrame:
        """A table as stored; its schema is inferred once, however often a job reads it."""
        path = f"{self.folder}/{table}.parquet"
        if table not in self._schemas:
            self._schemas[table] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[table]).parquet(path)

    def __call__(self, role: str, *columns: str) -> DataFrame:
        built = {
            "sale": self._sale, "appointment": self._appointment, "lead": self._lead,
            "prospect": self._prospect, "staff": self._staff, "project": self._project,
            "source_cost": self._source_cost, "marketing_source": self._marketing_source,
        }
        if role in built:
            return built[role](columns)
        df = getattr(self, f"_{role}")()
        return df.select(*columns) if columns else df

    def n_parts(self, role: str) -> int:
        """By the size of the base table's files."""
        size = self.raw(SPLIT[role][0])._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return min(PARTS, 1 + size // PART_BYTES)

    def parts(self, role: str, *columns: str) -> Iterator[DataFrame]:
        """All rows of a role of ``SPLIT``, in up to ``PARTS`` parts that are written one after the other.

        The joins of a wide role shuffle many times its size; a part shuffles its share.  Rows are told apart by a hash of
        the split column, NULL among its values; Spark infers the same filter for the parent of that key.
        """
        (table, key), n = SPLIT[role], self.n_parts(role)
        base = self.raw(table)
        for i in range(n):
            some = base.where(F.pmod(F.xxhash64(key), F.lit(n)) == i) if n > 1 else base
            yield getattr(self, f"_{role}")(columns, some)

    # -- joined roles ------------------------------------------------------

    def _pick(self, base: DataFrame, spec: Columns, parents: Parents, columns: tuple[str, ...]) -> DataFrame:
        columns = columns or tuple(spec)
        needed = {p for c in columns for p in spec[c][1]}
        for parent, join in parents.items():
            if parent in needed:
                base = join(base)
        return base.select(*[F.expr(spec[c][0]).alias(c) for c in columns])

    def _left(self, table: str, ours: str, theirs: str) -> Callable[[DataFrame], DataFrame]:
        return lambda df: df.join(self.raw(table), F.col(ours) == F.col(theirs), "left")

    def _sale(self, columns, base: DataFrame | None = None):
        return self._pick(self.raw("lineitem") if base is None else base, SALE, {
            "o": self._left("orders", "l_orderkey", "o_orderkey"),
            "p": self._left("part", "l_partkey", "p_partkey"),
            "s": self._left("supplier", "l_suppkey", "s_suppkey"),
            "c": self._left("customer", "o_custkey", "c_custkey"),
            "n": self._left("nation", "c_nationkey", "n_nationkey"),
            "r": self._left("region", "n_regionkey", "r_regionkey"),
        }, columns)

    def _appointment(self, columns, base: DataFrame | None = None):
        return self._pick(self.raw("events") if base is None else base, APPOINTMENT, {
            "c": self._left("customer", "user_id", "c_custkey"),
            "n": self._left("nation", "c_nationkey", "n_nationkey"),
            "r": self._left("region", "n_regionkey", "r_regionkey"),
        }, columns)

    def _lead(self, columns):
        return self._pick(self.raw("customer"), LEAD, {}, columns)

    def _prospect(self, columns):
        return self._pick(self.raw("customer"), PROSPECT, {}, columns)

    def _staff(self, columns):
        return self._pick(self.raw("supplier"), STAFF, {
            "n": self._left("nation", "s_nationkey", "n_nationkey")}, columns)

    def _project(self, columns):
        lines = self.raw("lineitem").groupBy(F.col("l_orderkey").alias("p_orderkey")).agg(
            F.max("l_shipdate").alias("last_ship"),
            F.count_if(F.col("l_linestatus") == "F").alias("closed_lines"),
            F.count("*").alias("order_lines"),
            F.sum(F.col("l_quantity").cast(MONEY)).alias("quantity"),
            F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_extendedprice").cast(MONEY))
                  .otherwise(F.lit(0).cast(MONEY))).alias("open_amount"),
            F.min("l_suppkey").alias("first_supplier"),
        )
        return self._pick(self.raw("orders"), PROJECT, {
            "l": lambda df: df.join(lines, F.col("o_orderkey") == F.col("p_orderkey"), "left"),
            "c": self._left("customer", "o_custkey", "c_custkey"),
            "n": self._left("nation", "c_nationkey", "n_nationkey"),
            "r": self._left("region", "n_regionkey", "r_regionkey"),
        }, columns)

    def _source_cost(self, columns):
        return self._pick(self.raw("lineitem"), SOURCE_COST, {
            "s": self._left("supplier", "l_suppkey", "s_suppkey"),
            "p": self._left("part", "l_partkey", "p_partkey"),
        }, columns)

    def _marketing_source(self, columns):
        return self._pick(self.raw("supplier"), MARKETING_SOURCE, {}, columns)

    # -- goal tables -------------------------------------------------------

    def _order_year(self) -> DataFrame:
        o = self.raw("orders")
        return o.groupBy(F.year("o_orderdate").alias("year")).agg(
            F.sum(F.col("o_totalprice").cast(MONEY)).cast("double").alias("amount"),
            F.count("*").cast("double").alias("orders"),
            F.count_if(F.col("o_orderstatus") == "F").cast("double").alias("done"),
            F.count_if(F.col("o_orderstatus") == "O").cast("double").alias("open"),
        )

    def _yearly_goals(self) -> DataFrame:
        """Per order year a ``goal`` and a ``Target`` row; one ``WBI_goal`` row of rates for the last year."""
        years = self._order_year()
        amounts = {
            "prod": "amount * factor", "service": "open * 1000 * factor", "std": "amount / 2 * factor",
            "prod_prod": "amount / 3 * factor", "crew_goals": "orders / 10 * factor",
            "service_stop": "open * factor", "service_prod_stop": "done * factor",
            "service_prod_sale": "done * 500 * factor", "sale_count": "orders * factor",
            "sold_amount": "amount * factor", "wcc": "done / 7 * factor",
        }
        rates = ("leads_taken", "leads_nd", "appointment_set", "appointment_canceled", "appointment_issued",
                 "sales_issued", "quoted", "sale_sold", "sale_cancelled")
        typed = years.select("*", F.expr(
            "explode(array(struct('goal' as type, 1.1D as factor), struct('Target' as type, 1.25D as factor)))"
        ).alias("t")).select("*", "t.*")
        goals = typed.select("year", "type", *[F.expr(e).alias(c) for c, e in amounts.items()],
                             *[F.lit(None).cast("double").alias(r) for r in rates])
        overall = years.agg(F.max("year").alias("year"), F.sum("orders").alias("orders"),
                            F.sum("done").alias("done"), F.sum("open").alias("open"))
        rate_row = overall.select(
            "year", F.lit("WBI_goal").alias("type"),
            *[F.lit(None).cast("double").alias(c) for c in amounts],
            *[F.expr(f"100 * ({'done' if i % 2 else 'open'} + orders / {i + 2}) / orders").alias(r)
              for i, r in enumerate(rates)])
        return goals.unionByName(rate_row)

    def _monthly_distribution(self) -> DataFrame:
        o = self.raw("orders")
        parts = {
            "value": "count(1)", "sales_value": f"sum(cast(o_totalprice as {MONEY}))",
            "prod_sale": "count_if(o_orderstatus = 'F')", "service_sale": "count_if(o_orderstatus = 'O')",
            "prod_prod": "count_if(o_orderpriority = '1-URGENT')",
            "service_prod": "count_if(o_orderpriority = '5-LOW')",
            "service_wcc": "count_if(o_orderpriority = '2-HIGH')",
        }
        aggregates = [F.expr(e).cast("double").alias(c) for c, e in parts.items()]
        months = o.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(*aggregates)
        years = o.groupBy(F.year("o_orderdate").alias("year")).agg(
            *[F.expr(e).cast("double").alias(f"y_{c}") for c, e in parts.items()])
        return months.join(years, "year").select(
            "year", "month", *[F.expr(f"try_divide({c}, y_{c})").alias(c) for c in parts])

    def _typed_lines(self) -> DataFrame:
        return self.raw("lineitem").join(self.raw("part"), F.col("l_partkey") == F.col("p_partkey"), "left")

    def _line_counts(self, *keys: Column) -> DataFrame:
        return self._typed_lines().groupBy(*keys).agg(
            F.count("*").cast("double").alias("lines"),
            F.count_if(F.col("l_returnflag") == "R").cast("double").alias("returned"),
            F.count_if(F.col("l_linestatus") == "F").cast("double").alias("closed"),
            F.sum(F.col("l_extendedprice").cast(MONEY)).cast("double").alias("amount"),
        )

    def _product_yearly_goals(self) -> DataFrame:
        counts = self._line_counts(F.year("l_shipdate").alias("year"), F.col("p_type").alias("product_category"))
        return counts.selectExpr(
            "year", "product_category", "lines as leads_taken", "lines - returned as leads_nd",
            "closed as appointment_set", "returned as appointment_canceled",
            "closed - returned as appointment_issued", "lines / 2 as quoted", "closed / 3 as sale_sold",
            "returned / 4 as sale_cancelled", "amount / 50 as marketing", "amount as prod",
            "amount / 5 as service", "amount / 2 as std")

    def _goal_distribution(self) -> DataFrame:
        counts = self._line_counts(F.year("l_shipdate").alias("year"), F.col("p_type").alias("product_category"))
        return counts.selectExpr(
            "year", "product_category", "lines as leads_nd", "closed as issued_unique", "lines / 2 as quoted",
            "lines - returned as sold", "returned as canceled", "amount as net", "amount / lines as adl",
            "closed / 9 as sale_service", "amount / 9 as sale_service_net_amt", "amount / 20 as marketing")

    def _goal_distribution_name(self) -> DataFrame:
        counts = self._line_counts(
            F.year("l_shipdate").alias("year"), F.col("p_type").alias("product_category"),
            F.concat(F.lit("Rep "), "l_returnflag", "l_linestatus").alias("name"))
        return counts.selectExpr("year", "product_category", "name", "amount as net_sale", "lines as net_sale_count")

    # -- daily tables ------------------------------------------------------

    def _leads_nd_daily(self) -> DataFrame:
        return self.raw("orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(
            F.count("*").cast("double").alias("leads_nd"))

    def _marketing_daily(self) -> DataFrame:
        return self._typed_lines().selectExpr(
            "to_date(l_shipdate) as date", "p_type as product_category",
            f"cast(l_extendedprice * l_discount as {MONEY}) as per_lead_cost",
            f"cast(l_extendedprice * l_tax as {MONEY}) as total_cost")

    def _sale_rep_prod_cat(self) -> DataFrame:
        return self._typed_lines().selectExpr(
            "to_date(l_shipdate) as date", "lower(p_type) as product_category",
            f"cast(l_extendedprice * l_discount as {MONEY}) as prod",
            f"case when l_linestatus = 'O' then cast(l_extendedprice as {MONEY}) end as service",
            f"cast(l_extendedprice * (1 - l_discount) as {MONEY}) as std")

    def _actual_prod_cat(self) -> DataFrame:
        """Raw category funnel; several rows per day and category, and a NULL category."""
        counts = self._line_counts(
            F.to_date("l_shipdate").alias("date"), F.col("l_linestatus").alias("line_status"),
            F.expr("case when p_type = 'SMALL' and l_linestatus = 'O' then null "
                   "when l_linestatus = 'F' then lower(p_type) else p_type end").alias("product_category"))
        return counts.selectExpr(
            "date", "'actual' as type", "product_category", "lines as leads_taken",
            "lines - returned as leads_nd", "closed as appointments_set",
            "returned as appointments_cancelled", "lines / 2 as appointments_issued_cc",
            "lines / 4 as appointments_issued_sale", "closed / 2 as quote",
            "lines - returned as sold", "returned as cancelled")

    def _actual_goal_date(self) -> DataFrame:
        return self._actual_prod_cat().withColumnRenamed("quote", "quote_issued")

    def _goals_by_date(self) -> DataFrame:
        return self._order_days().selectExpr(
            "date", "'goal' as type", "orders as leads_taken", "done as leads_nd", "open as appointments_set",
            "orders / 2 as appointments_cancelled", "orders / 3 as appointments_issued_cc",
            "orders / 4 as appointments_issued_sale", "orders / 5 as quote_issued",
            "done / 2 as sale_sold", "open / 2 as sale_cancelled")

    def _order_days(self) -> DataFrame:
        return self.raw("orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(
            F.count("*").cast("double").alias("orders"),
            F.count_if(F.col("o_orderstatus") == "F").cast("double").alias("done"),
            F.count_if(F.col("o_orderstatus") == "O").cast("double").alias("open"),
            F.sum(F.col("o_totalprice").cast(MONEY)).cast("double").alias("amount"))

    def _goal_by_date(self) -> DataFrame:
        return self._order_days().selectExpr(
            "date", "orders as goal_leads_all", "orders / 2 as goal_leads_taken", "done as goal_leads_nd",
            "open as goal_appointments_set", "orders / 3 as goal_appointments_cancelled",
            "orders / 4 as goal_appointments_issued", "orders / 5 as goal_quote_issued",
            "done / 2 as goal_sale_sold", "orders * 0 as goal_sale_cancelled",
            "amount as goal_marketing_expenses")

    def _customer_funnel(self) -> DataFrame:
        """Raw funnel, one row per ship day and category."""
        counts = self._line_counts(F.to_date("l_shipdate").alias("date"), F.col("p_type").alias("product_category"))
        return counts.selectExpr(
            "date", "'actual' as type", "cast(null as string) as sale_rep", "product_category",
            "concat('Source ', product_category) as source_name", "'Internet' as source_type",
            "cast(null as string) as team_lead", "lines as leads_all", "lines as leads_taken",
            "lines - returned as leads_nd", "closed as appointments_set", "returned as appointments_cancelled",
            "lines / 3 as appointments_issued", "lines / 2 as appointments_issued_cc",
            "lines / 4 as appointments_issued_sale", "closed / 2 as quote_issued", "amount as sold_total",
            "lines - returned as sold", "lines - returned as sale_sold", "returned as cancelled",
            "returned as sale_cancelled", "amount / 8 as cancelled_amount", "amount / lines as adl", "amount / 7 as ads", "amount / 11 as marketing_expenses")

    # -- staged tables -----------------------------------------------------

    def _stage_actual_prod_cat(self) -> DataFrame:
        from leadflow.plans import stage
        return stage.stage_actual_prod_cat(self)

    def _stage_customer_funnel(self) -> DataFrame:
        from leadflow.plans import stage
        return stage.stage_customer_funnel(self)
