"""Oracle SQL of the operator queries and of the dashboard measures."""

from __future__ import annotations

from .build import AFTER, AS_OF, EXSRC, days, folded, sql
from .reports import R, SET_DAY, daily, even
from .roles import m

O: dict[str, str] = {}

# -- sources -----------------------------------------------------------------
O["src_load_object"] = sql([], {}, "select * replace (cast(o_orderdate as date) as o_orderdate) from orders",
                           keys="o_orderstatus o_orderdate o_orderpriority", ints="o_orderkey o_custkey", doubles="o_totalprice")
O["conform_types"] = sql([], {}, "select *, '[' || p_size || ',1]' as sizes, 'bigint' as type_of_size from part",
                         keys="p_name p_brand p_type sizes type_of_size", ints="p_partkey p_size", doubles="p_retailprice")
O["nan_to_null"] = sql([], {}, "select event_id, event_type, case when event_type = 'error' then null else value end as value from events",
                       keys="event_type", ints="event_id", doubles="value")
O["incremental_pull"] = sql([], {}, "select o_orderkey, cast(o_orderdate as date) as o_orderdate from orders where o_orderdate >= timestamp '2000-06-15 00:00:00'",
                            keys="o_orderdate", ints="o_orderkey")
O["unpivot_monthly_share"] = sql([], {}, f"""
    select year(o_orderdate) as year, month(o_orderdate) as month, cast(sum({m('o_totalprice')}) as double) / 7 as value from orders group by 1, 2""",
    ints="year month", doubles="value")
O["merge_monthly_shares"] = sql([], {}, f"""
    select year(o_orderdate) as year, month(o_orderdate) as month, sum({m('o_totalprice')}) as sales_value, count(*) as prod_sale,
           nullif(count_if(o_orderpriority = '1-URGENT'), 0) as service_sale from orders group by 1, 2""",
    ints="year month", doubles="sales_value prod_sale service_sale")
O["unpivot_goals"] = sql(["typed_line"], {}, """
    select year(date) as year, p_type as product_category, case when l_linestatus = 'F' then 'Crew ' || p_type end as name,
           count(*) as sold, sum(ext) as net from typed_line group by 1, 2, 3""",
    keys="product_category name", ints="year", doubles="sold net")
O["load_pairs"] = sql([], {}, """
    select distinct team, employee from (
        select case when c_mktsegment = 'FURNITURE' then '' else c_mktsegment end as team,
               case when c_custkey % 7 = 0 then null else 'Rep ' || cast(c_custkey % 40 as varchar) end as employee from customer) p
    where coalesce(team, '') <> '' and coalesce(employee, '') <> ''""", keys="team employee")
O["kpi_cells_snapshot"] = sql([], {}, f"""
    select cast(count_if(o_orderstatus = 'F') as double) / count(*) as sales_pct, sum({m('o_totalprice')}) as net_sales,
           null as production_pct, '2001-08-01 06:30' as created from orders""",
    keys="created", doubles="sales_pct net_sales production_pct")
O["to_day"] = sql(["appointment"], {}, f"select id, {SET_DAY} as day from appointment", keys="id day")
O["calendar"] = sql([], {
    "o": "select cast(o_orderdate as date) as date, count(*) as orders from orders group by 1",
    "ends": "select max(date) as last_day from o",
    "cal": f"select cast(d as date) as date from ends, range({AFTER} + interval 1 day, last_day + interval 1 day, interval 1 day) t(d)"},
    "select cal.date, o.orders from cal left join o on cal.date = o.date", keys="date", ints="orders")

# -- sinks -------------------------------------------------------------------
_UP = {
    "target": f"select o_orderkey as id, o_orderstatus as status, {m('o_totalprice')} as price from orders",
    "changes": f"""select case when l_linenumber = 7 then l_orderkey + 1000000000 else l_orderkey end as id,
        l_returnflag || l_linestatus as status, case when l_returnflag = 'R' then null else {m('l_extendedprice')} end as price,
        l_shipdate, l_linenumber, l_partkey, l_suppkey from lineitem""",
    "newest": """select id, status, price from (select *, row_number() over (partition by id order by l_shipdate desc,
        l_linenumber desc, l_partkey desc, l_suppkey desc, price desc nulls last, status desc) as rn from changes) x where rn = 1""",
    "oldest": """select id, status, price from (select *, row_number() over (partition by id order by l_shipdate,
        l_linenumber, l_partkey, l_suppkey, price nulls first, status) as rn from changes) x where rn = 1""",
}


def _up(step: str, select: str) -> str:
    return sql([], {k: v for k, v in _UP.items() if k in ("target", "changes", step)}, select,
               keys="status", ints="id", doubles="price")


O["upsert_by_key"] = _up("newest", """
    select * from target where id not in (select id from newest) union all select * from newest""")
O["stream_upsert"] = O["upsert_by_key"]
O["insert_ignore"] = _up("oldest", "select * from target union all select * from oldest where id not in (select id from target)")
O["upsert_column"] = _up("newest", """
    select coalesce(t.id, n.id) as id, t.status, coalesce(n.price, t.price) as price
    from target t full join (select * from newest where price is not null) n on t.id = n.id""")
O["update_if_changed"] = sql([], {
    "old": "select cast(o_orderdate as date) as date, count(*) as v from orders group by 1",
    "new": """select date, case when n % 5 = 0 then null else n // 4 end as v
              from (select cast(l_shipdate as date) as date, count(distinct l_orderkey) as n from lineitem group by 1) s"""},
    """select coalesce(o.date, n.date) as date, case when n.date is null then o.v else n.v end as crew_worked,
              case when n.date is null then 'none' when o.date is null then 'insert'
                   when o.v is distinct from n.v then 'update' else 'none' end as action
       from old o full join new n on o.date = n.date""", keys="date action", ints="crew_worked")
O["snapshot_replace"] = sql([], {"target": _UP["target"]}, "select * from target where status <> 'P'",
                            keys="status", ints="id", doubles="price")
O["stage_cast"] = sql(["appointment"], {}, """
    select try_cast(set_on as date) as date, try_cast(id as bigint) as id, try_cast(zip as double) as zip,
           try_cast(issued as double) as issued from (
        select split_part(set_on, 'T', 1) as set_on, id, zip, issued from appointment) a""",
    keys="date", ints="id", doubles="zip issued")
_OPEN = "pct_complete < 100 and lower(status) = 'active' and lower(coalesce(job_type, '')) <> '021 - service work'"
O["vtc_daily_snapshot"] = sql(["project"], {
    "history": f"select cast(o_orderdate as date) as date, sum({m('o_totalprice')}) as vtc from orders group by 1"},
    f"""select * from history where date <> date '2001-07-31'
        union all select date '2001-07-31', sum(value_to_complete) from project where {_OPEN}""",
    keys="date", doubles="vtc")
O["vtc_today"] = sql(["project"], {}, f"select {AS_OF} as date, sum(value_to_complete) as vtc from project where {_OPEN}",
                     keys="date", doubles="vtc")

# -- text rules, joins ---------------------------------------------------------
O["ci_filter"] = sql(["appointment"], {}, f"""
    select appt_type, count_if(lower(source_type) in {EXSRC}) as is_in, count_if(lower(source_type) not in {EXSRC}) as not_in,
           count_if(lower(coalesce(source_type, '')) not in {EXSRC}) as not_in_or_null,
           count_if(category not ilike 'service') as not_equal, count_if(coalesce(category, '') not ilike 'service') as not_equal_or_null,
           count_if(category ilike 'economy') as equal from appointment group by 1""",
    keys="appt_type", ints="is_in not_in not_in_or_null not_equal not_equal_or_null equal")
O["disqualified"] = sql(["prospect", "disq"], {}, """
    select not_qualified_reason, count(*) as prospects, count_if(id in (select id from disq)) as turned_away from prospect group by 1""",
    keys="not_qualified_reason", ints="prospects turned_away")
O["conform_name"] = sql(["appointment"], {}, "select trim(lower(rep)) as staff, count(*) as n from appointment group by 1",
                        keys="staff", ints="n")
O["calendar_left"] = sql(["appointment"], {
    "f": f"select {SET_DAY} as date, category as product_category from appointment",
    "cal": days("date '2000-01-20'", "date '1997-01-10'")},
    """select cal.date, min(f.product_category) as product_category, sum(case when f.date is not null then 1 end) as set_count
       from cal left join f on cal.date = f.date group by cal.date, lower(f.product_category)""",
    keys="date product_category", ints="set_count")
O["lookup_default"] = sql(["appointment", "staff"], {}, """
    select set_by, coalesce(s.name, 'Unassigned') as name, s.team_lead, count(*) as n
    from appointment a left join staff s on lower(a.set_by) = lower(s.id) group by 1, 2, 3""",
    keys="set_by name team_lead", ints="n")
O["leads_qualified"] = sql(["lead", "disq"], {}, """
    select id, prospect_id, taken_on from lead l where not exists (select 1 from disq d where lower(d.id) = lower(l.prospect_id))""",
    keys="id prospect_id taken_on")
O["semi_category"] = sql(["appointment", "sale"], {}, """
    select category as product_category, count(*) as n from appointment where lower(category) in (select lower(category) from sale) group by 1""",
    keys="product_category", ints="n")
_SPAN = ("date '1999-06-30'", "date '1999-01-05'")
O["full_outer_cost_leads"] = sql(["lead", "source_cost"], {
    "cal": days(*_SPAN),
    "l": folded("(select taken_on as date, source_type, 1 as leads from lead)", "source_type", "leads"),
    "c": """select paid_on as date, case when cast(marketing_source_id as bigint) % 2 = 0 then 'Building' else 'household' end as source_type,
                   sum(amount) as cost from source_cost group by 1, 2"""},
    """select cal.date, coalesce(l.source_type, c.source_type) as source_type, coalesce(l.leads, 0) as leads_nd, coalesce(c.cost, 0) as total_cost
       from cal left join l on cal.date = l.date left join c on cal.date = c.date and lower(l.source_type) = lower(c.source_type)
       union all
       select cal.date, c.source_type, 0, c.cost from cal right join c on cal.date = c.date
       left join l on cal.date = l.date and lower(c.source_type) = lower(l.source_type) where l.date is null""",
    keys="date source_type", ints="leads_nd", doubles="total_cost")
O["first_touch"] = sql(["appointment"], {}, f"""
    select lower(lead_id) as lead_id, set_by from (
        select lead_id, set_by, row_number() over (partition by lead_id order by set_on, id) as rn
        from appointment where lead_id is not null and {SET_DAY} is not null) x where rn = 1""", keys="lead_id set_by")

# -- goals -----------------------------------------------------------------------
O["goal_allocate_daily"] = sql(["goal_distribution", "monthly_distribution"], {
    "x": daily("goal_distribution", {"net": ("net", "sales_value")}, "product_category")},
    "select date, min(product_category) as product_category, sum(net) as net from x group by date, lower(product_category)",
    keys="date product_category", doubles="net")
O["goal_even_split"] = sql(["product_yearly_goals"], {"x": even({"prod": "prod"})}, "select * from x",
                           keys="date product_category", doubles="prod")
_MONTHLY = {"mo": f"""select cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month,
    cast(sum({m('o_totalprice')}) as double) as amount, cast(count(*) as double) as orders from orders group by 1, 2"""}
O["trailing_mean"] = sql([], _MONTHLY, """
    select year, month, avg(amount) over w as amount, avg(orders) over w as orders from mo
    window w as (partition by month order by year rows between 3 preceding and 1 preceding)""",
    ints="year month", doubles="amount orders")
O["share_of_year"] = sql([], _MONTHLY, """
    select *, amount / nullif(sum(amount) over (partition by year), 0) * 100 as amount_pct,
           orders / nullif(sum(orders) over (partition by year), 0) * 100 as orders_pct from mo""",
    ints="year month", doubles="amount orders amount_pct orders_pct")
O["funnel_chain"] = sql(["leads_nd_daily", "rates"], {}, """
    select date, round(a.leads_nd, 5) as leads_nd, round(round(a.leads_nd, 5) * (appointment_set / 100), 5) as set_count,
           round(set_count * (b.quoted / 100), 5) as quoted, round(set_count * (b.sale_sold / 100), 5) as sold
    from leads_nd_daily a, rates b""", keys="date", doubles="leads_nd set_count quoted sold")
O["fact_union"] = sql(["sale", "project"], {"u": """
    select sold_on as date, rep as staff, sold, 0 as earned from sale
    union all select start_on, rep, 0, value_earned from project"""}, folded("u", "staff", "sold earned"),
    keys="date staff", ints="sold", doubles="earned")
O["safe_ratio"] = sql(["appointment"], {}, """
    select start_on as date, case when sum(issued) = 0 then 0 else cast(sum(sold) as double) / sum(issued) end as guarded,
           cast(sum(sold) as double) / nullif(sum(issued), 0) as plain from appointment group by 1""",
    keys="date", doubles="guarded plain")
O["stack_actual_goal"] = sql(["typed_line"], _MONTHLY, """
    select year, month, 'actual' as type, amount from mo
    union all select year(date), month(date), 'goal', cast(sum(ext) as double) from typed_line group by 1, 2""",
    keys="type", ints="year month", doubles="amount")

# -- stage ------------------------------------------------------------------------
_F = ("leads_taken leads_nd appointments_set appointments_cancelled appointments_issued_cc appointments_issued_sale "
      "quote_issued ")
O["stage_actual_prod_cat"] = sql(["actual_prod_cat"], {}, "select * from actual_prod_cat",
                                 keys="date type product_category", doubles=_F + "sold cancelled")
O["stage_actual_goal_date"] = O["stage_actual_prod_cat"]
O["stage_customer_funnel"] = sql(["customer_funnel"], {}, "select * from customer_funnel",
                                 keys="date type sale_rep product_category source_name source_type team_lead",
                                 doubles=_F + "sold_total sale_sold sale_cancelled sale_cancelled_amount adl ads")
O["stage_customer_funnel_goal"] = sql(["order_day"], {}, """
    select date, 'goal' as type, orders as leads_taken, done as leads_nd, opened as appointments_set, orders / 2 as appointments_cancelled,
           orders / 3 as appointments_issued_cc, orders / 4 as appointments_issued_sale, orders / 5 as quote_issued,
           done / 2 as sale_sold, opened / 2 as sale_cancelled from order_day""",
    keys="date type", doubles=_F + "sale_sold sale_cancelled")
O["stream_daily_funnel"] = sql([], {}, """
    select cast(ts as date) as date, cast(event_id % 7 as varchar) as category,
           count_if(event_type = 'signup') as leads, count_if(event_type = 'view') as visits, count_if(event_type = 'purchase') as sold
    from events group by 1, 2""", keys="date category", ints="leads visits sold")

# -- dashboard measures, on top of the report SQL ------------------------------------


def over(report: str, select: str, **columns: str) -> str:
    return sql([], {"r": R[report]}, select, **columns)


O["funnel_conversion"] = over("customer_care", """
    select *, 100 * cast(leads_nd as double) / nullif(leads_taken, 0) as qualified_pct,
           100 * cast(appointments_set as double) / nullif(leads_nd, 0) as set_pct,
           100 * cast(appointments_issued as double) / nullif(appointments_set, 0) as issued_pct
    from (select lower(product_category) as product_category, sum(leads_taken) as leads_taken, sum(leads_nd) as leads_nd,
                 sum(appointments_set) as appointments_set, sum(appointments_issued) as appointments_issued from r group by 1) s""",
    keys="product_category", ints="leads_taken leads_nd appointments_set appointments_issued",
    doubles="qualified_pct set_pct issued_pct")
O["weekly_trend"] = over("customer_care", """
    select cast(date_trunc('week', date) as date) as week, sum(leads_taken) as leads_taken, sum(leads_nd) as leads_nd,
           sum(appointments_set) as appointments_set, sum(appointments_cancelled) as appointments_cancelled,
           sum(appointments_issued) as appointments_issued from r group by 1""",
    keys="week", ints="leads_taken leads_nd appointments_set appointments_cancelled appointments_issued")
O["category_rates"] = over("ads_adl_by_staff", """
    select *, total_sold - total_cancelled_amount as net_revenue, 100 * cast(sold as double) / nullif(issued_unique, 0) as close_pct,
           100 * cast(total_cancelled as double) / nullif(sold, 0) as cancel_pct
    from (select lower(product_category) as product_category, sum(issued_unique) as issued_unique, sum(quoted) as quoted,
                 sum(sold) as sold, sum(total_cancelled) as total_cancelled, sum(total_sold) as total_sold,
                 sum(total_cancelled_amount) as total_cancelled_amount from r group by 1) s""",
    keys="product_category", ints="issued_unique quoted sold total_cancelled",
    doubles="total_sold total_cancelled_amount net_revenue close_pct cancel_pct")
O["period_filter"] = over("sale_sold_canceled", f"""
    select period, sum(sale_sold) as sale_sold, sum(sale_cancelled) as sale_cancelled, sum(total_sale) as total_sale,
           sum(cancelled_amt) as cancelled_amt
    from r join (values ('R12', date '2000-08-02', date '2001-08-01'), ('YTD', date '2001-01-01', date '2001-08-01'),
                        ('today', date '2001-08-01', date '2001-08-01'), ('yesterday', date '2001-07-31', date '2001-07-31'),
                        ('this_week_to_date', date '2001-07-30', date '2001-08-01'),
                        ('last_week_to_date', date '2001-07-23', date '2001-07-25'),
                        ('R4W', date '2001-07-05', date '2001-08-01')) p(period, first_day, last_day)
    on r.date between p.first_day and p.last_day group by 1""",
    keys="period", ints="sale_sold sale_cancelled", doubles="total_sale cancelled_amt")
O["vtc_cumulative"] = sql(["project"], {
    "d": f"select start_on as date, sum(value_to_complete) as vtc from project where {_OPEN} and start_on is not null group by 1"},
    "select *, sum(vtc) over (partition by year(date) order by date) as vtc_to_date from d", keys="date", doubles="vtc vtc_to_date")
O["vtc_by_status"] = sql(["project"], {}, """
    select lower(status) as status, count(*) as projects, sum(value_to_complete) as vtc from project group by 1""",
    keys="status", ints="projects", doubles="vtc")
O["project_status_counts"] = sql(["project"], {}, """
    select cast(date_trunc('month', start_on) as date) as month, count(*) as projects,
           count_if(state = 'done') as completed, count_if(state = 'open') as pending, count_if(state = 'off') as canceled,
           100 * cast(count_if(state = 'done') as double) / count(*) as completed_pct
    from (select start_on, case when lower(status) = 'canceled' then 'off' when pct_complete >= 100 then 'done' else 'open' end as state
          from project) s group by 1""", keys="month", ints="projects completed pending canceled", doubles="completed_pct")

OPERATORS = O
