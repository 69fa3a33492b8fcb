"""Oracle SQL of the queries that load in batches: the full result over the final rows."""

from __future__ import annotations

from .build import sql
from .reports import R
from .roles import ROLES, m

L: dict[str, str] = {}
_TENTH = "cast(split_part(id, '-', 1) as bigint) % 10"

# -- keyed tables by partition --------------------------------------------------
_LATEST = """row_number() over (partition by id order by l_shipdate desc, l_linenumber desc, l_partkey desc, l_suppkey desc,
        price desc, status desc)"""
_CHANGES = f"""select l_orderkey as id, l_returnflag || l_linestatus as status, {m('l_extendedprice')} as price, l_linestatus as batch,
        case when l_partkey % 19 <> 0 then strftime(l_shipdate, '%Y-%m') end as month, l_shipdate, l_linenumber, l_partkey, l_suppkey
        from lineitem"""
L["upsert_partitions"] = sql([], {
    "f": f"select id, status, price, month from (select *, {_LATEST} as rn from ({_CHANGES}) x where batch = 'F') y where rn = 1",
    "o": f"select id, status, price, month from (select *, {_LATEST} as rn from ({_CHANGES}) x where batch = 'O') y where rn = 1"}, f"""
    select * from o union all select * from f where id not in (select id from o)
    union all select o_orderkey, o_orderstatus, {m('o_totalprice')},
           case when o_orderkey % 17 <> 0 then strftime(o_orderdate, '%Y-%m') end from orders
    where o_orderkey not in (select id from o) and o_orderkey not in (select id from f)""",
    keys="status month", ints="id", doubles="price")

# -- kept sums and touches ----------------------------------------------------------


def _with(report: str, **roles: str) -> str:
    """A report's SQL over changed roles; ``{role}`` in a change stands for the role as it was."""
    text = R[report]
    for role, change in roles.items():
        before = f"{role} as ({ROLES[role].strip()})"
        assert before in text, role
        text = text.replace(before, f"{role} as ({change.replace('{' + role + '}', ROLES[role].strip())})")
    return text


_SALES = f"""
    with s0 as ({{sale}}),
    s1 as (select * replace (case when {_TENTH} = 1 then {m('total_sales * 2')} else total_sales end as total_sales,
                             case when {_TENTH} = 1 then sold_on + 31 else sold_on end as sold_on) from s0),
    s2 as (select * replace (case when {_TENTH} in (1, 2) then true else canceled end as canceled,
                             case when {_TENTH} in (1, 2) then sold_on + 10 else canceled_date end as canceled_date,
                             case when {_TENTH} in (1, 2) then total_sales else canceled_amt end as canceled_amt,
                             case when {_TENTH} in (1, 2) and id like '%2' then 'Service' else department end as department) from s1)
    select * replace (case when {_TENTH} = 1 then null else sold_price end as sold_price) from s2
    union all select * replace (id || '-n' as id, sold_on - 7 as sold_on) from s2 where {_TENTH} = 3"""
_VISITS = f"""
    with a0 as ({{appointment}})
    select * replace (case when {_TENTH} = 4 then start_on + 1 else start_on end as start_on,
                      case when {_TENTH} = 4 then issued_unique + 1 else issued_unique end as issued_unique) from a0"""
L["kept_ads_adl"] = _with("ads_adl", sale=_SALES, appointment=_VISITS)
_LEADS = f"""
    with l0 as ({{lead}})
    select * replace (case when {_TENTH} in (3, 5) then taken_on + 3 else taken_on end as taken_on,
                      case when {_TENTH} in (3, 5) then 'promo' else category end as category) from l0
    union all select * replace (id || '-n' as id, id || '-n' as prospect_id) from l0 where {_TENTH} = 6"""
_PROSPECTS = f"""
    with p0 as ({{prospect}})
    select * replace (case when {_TENTH} in (3, 4) then 'It is SPAM' when {_TENTH} = 0 then null
                           else not_qualified_reason end as not_qualified_reason) from p0
    union all select * replace (id || '-n' as id, 'out of AREA' as not_qualified_reason) from p0 where {_TENTH} = 6"""
L["kept_customer_care"] = _with("customer_care", lead=_LEADS, prospect=_PROSPECTS)
L["kept_first_touch"] = sql(["appointment"], {"final": """
    select id, set_by, case when cast(id as bigint) % 5 = 1 then 'x' || lead_id else lead_id end as lead_id,
           case when cast(id as bigint) % 5 <> 1 and cast(id as bigint) % 7 = 3 then '2009-' || substring(set_on, 6) else set_on end as set_on
    from appointment"""}, """
    select lower(lead_id) as lead_id, set_by from (
        select *, row_number() over (partition by lower(lead_id) order by set_on nulls first, id) as rn
        from final where lead_id is not null) x where rn = 1""", keys="lead_id set_by")

# -- a stream, runs -------------------------------------------------------------------
L["stream_folds"] = sql([], {}, f"""
    select id, status, price from (select *, {_LATEST} as rn from ({_CHANGES}) x) y where rn = 1""",
    keys="status", ints="id", doubles="price")
L["incremental_load"] = sql([], {}, """
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(o_orderdate as date) as o_orderdate,
           strftime(o_orderdate, '%Y-%m') as month from orders""",
    keys="o_orderstatus o_orderdate month", ints="o_orderkey o_custkey", doubles="o_totalprice")


def _content(name: str, columns: str, source: str | None = None) -> str:
    """Rows and checksum of a table; columns marked with # are amounts at four decimals."""
    cells = []
    for column in columns.split():
        x = column.strip("#")
        shown = f"cast(round(cast({x} as decimal(30,8)), 4) as decimal(28,4))" if column.endswith("#") else x
        cells.append(f"coalesce(cast({shown} as varchar), '~')")
    return (f"select '{name}' as table_name, count(*) as row_count, "
            f"sum(cast('0x' || substr(md5(concat_ws('|', {', '.join(cells)})), 1, 8) as bigint)) as content from {source or name}")


_FUNNEL = ("leads_taken# leads_nd# appointments_set# appointments_cancelled# appointments_issued_cc# appointments_issued_sale# "
           "quote_issued# ")
_OPEN = "pct_complete < 100 and lower(status) = 'active' and lower(coalesce(job_type, '')) <> '021 - service work'"
_PARTS = [
    _content("sale", "id sold_on canceled canceled_date canceled_amt# total_sales# sold_price# orig_price# net_sales# sold category rep "
             "sale_type department appt_type foreman_sale_date foreman_basis# completed_by_dept completed_by_foreman city state zip "
             "address", f"(select * replace (case when {_TENTH} = 7 then sold_on + 400 else sold_on end as sold_on) from sale) s"),
    _content("appointment", "id lead_id start_on set_on canceled_on canceled appt_type category source_type rep rep_consolidated rep_dept "
             "set_by team_lead issued issued_unique quoted sold city state zip address"),
    _content("lead", "id prospect_id taken_on category source_type",
             f"(select * from lead union all select * replace (id || '-n' as id) from lead where {_TENTH} = 2) l"),
    _content("prospect", "id not_qualified_reason"),
    _content("staff", "id name team_lead start_on title"),
    _content("project", "id start_on sold_on completed_on status job_type pct_complete# value_earned# value_to_complete# category foreman "
             "rep city state zip address"),
    _content("source_cost", "name marketing_source_id category paid_on amount#"),
    _content("marketing_source", "id source_type"),
    _content("project_week_snapshot", "id status pct_complete# week", "(select *, date '2001-07-30' as week from project) p"),
    _content("raw_orders", "o_orderkey o_custkey o_orderstatus o_totalprice# o_orderdate o_orderpriority", "orders"),
    _content("raw_lineitem", "l_orderkey l_partkey l_suppkey l_linenumber l_quantity# l_extendedprice# l_discount# l_tax# l_returnflag "
             "l_linestatus l_shipdate", "lineitem"),
    _content("raw_part", "p_partkey p_name p_brand p_type p_size p_retailprice#", "part"),
    _content("monthly_distribution", "year month value#", """(
        select year, month, value + case when year < 2000 and month = 1 then 1 else 0 end as value from monthly_distribution) d"""),
    _content("stage_actual_prod_cat", "date type product_category " + _FUNNEL + "sold# cancelled#", "actual_prod_cat"),
    _content("stage_actual_goal_date", "date type product_category " + _FUNNEL + "sold# cancelled#", "actual_prod_cat"),
    _content("stage_customer_funnel", "date type sale_rep product_category source_name source_type team_lead " + _FUNNEL
             + "sold_total# sale_sold# sale_cancelled# sale_cancelled_amount# adl# ads#", "customer_funnel"),
    _content("vtc_dates", "date vtc#", f"""(
        select d as date, (select sum(value_to_complete) from project where {_OPEN}) as vtc
        from (values (date '2001-07-30'), (date '2001-07-31')) t(d)) v"""),
    _content("weekly_crew_logs", "date crew_worked",
             "(select cast(o_orderdate as date) as date, count(*) as crew_worked from orders group by 1) c"),
]
L["run_pipeline"] = sql(["sale", "appointment", "lead", "prospect", "staff", "project", "source_cost", "marketing_source",
                         "monthly_distribution", "actual_prod_cat", "customer_funnel"], {}, "\n    union all ".join(_PARTS),
                        keys="table_name", ints="row_count content")

for _report in ("customer_care", "customer_care_v2", "staff_location"):
    L[f"silver_{_report}"] = R[_report]

# -- spellings, sheets ------------------------------------------------------------------
_NAMES = "'José', 'JOSE', 'jose', 'Jose\u0301', ' Zoë ', 'ZOE', 'Ñandú', 'nandu'"
L["folded_names"] = sql([], {
    "p": f"select date '1999-01-01' + cast(c_custkey % 5 as int) as date, ([{_NAMES}])[c_custkey % 8 + 1] as name from customer",
    "g": """select date, min(trim(lower(name))) as staff, strip_accents(trim(lower(name))) as plain, count(*) as n,
                   count_if(strip_accents(lower(trim(name))) = 'zoe') as zoe,
                   count_if(strip_accents(lower(name)) in ('jose', 'nandu')) as named_in,
                   count_if(contains(strip_accents(lower(name)), 'andu')) as holds
            from p group by 1, 3""",
    "w": "select distinct (['jose', 'zoe', 'nandu'])[c_custkey % 3 + 1] as plain, 'Team ' || c_custkey % 3 as team from customer"}, """
    select date, staff, n, zoe, named_in, holds, coalesce(team, 'none') as team from g left join w on g.plain = w.plain""",
    keys="date staff team", ints="n zoe named_in holds")
L["sheet_end"] = sql([], {
    "v": f"""select year(o_orderdate) as year, month(o_orderdate) as month, round(cast(sum({m('o_totalprice')}) as double), 10) as value
             from orders where year(o_orderdate) < 1998 group by 1, 2"""}, """
    select *, 'csv' as file from v union all select *, 'parquet' from v""", keys="file", ints="year month", doubles="value")

LOADS = L
