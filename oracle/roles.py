"""The KPI roles as DuckDB SQL over the star-schema views, one CTE per role."""

EVENT_DAY = "(cast(ts as date) + cast((user_id % 7 - 4) * 365 - 9131 as integer))"
SOURCE_TYPE = ("case c_mktsegment when 'MACHINERY' then 'Existing Database' "
               "when 'FURNITURE' then null else c_mktsegment end")


def category(key: str) -> str:
    return (f"case {key} % 7 when 0 then null when 1 then 'service work' when 2 then 'Service' "
            f"when 3 then 'ECONOMY' when 4 then 'Economy' when 5 then 'PROMO' else '' end")


def m(expr: str) -> str:
    return f"cast({expr} as decimal(18,4))"


ROLES = {
    "sale": f"""
        select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_shipdate as date) - date '1970-01-01',
                         cast(l_quantity as int)) as id,
               case when l_returnflag = 'R' and o_orderstatus = 'P' then null else cast(o_orderdate as date) end as sold_on,
               l_returnflag = 'R' as canceled,
               case when l_returnflag = 'R' then cast(l_shipdate as date) end as canceled_date,
               case when l_returnflag = 'R' then {m('l_extendedprice')} end as canceled_amt,
               {m('l_extendedprice')} as total_sales,
               {m('l_extendedprice * (1 - l_discount)')} as sold_price,
               {m('l_extendedprice * (1 + l_tax)')} as orig_price,
               {m('l_extendedprice * (1 - l_discount)')} as net_sales,
               1 as sold, p_type as category,
               case when l_linenumber % 2 = 0 then upper(s_name) else s_name end as rep,
               case o_orderpriority when '1-URGENT' then 'Service Opportunity' when '5-LOW' then 'annual maintenance'
                    when '4-NOT SPECIFIED' then null else 'Standard' end as sale_type,
               case when o_orderstatus = 'O' then 'Service' else 'Sales' end as department,
               case l_linenumber when 1 then 'New' when 2 then 'reset' when 3 then 'Rehash'
                    when 4 then 'Radon CRM Pickup' when 5 then null else 'WCC' end as appt_type,
               case when l_linestatus = 'F' then cast(l_shipdate as date) end as foreman_sale_date,
               {m('l_extendedprice * l_discount')} as foreman_basis,
               case when l_linestatus = 'F' then 'Service Dept.' when l_returnflag = 'N' then null
                    else 'Production Dept.' end as completed_by_dept,
               s_name as completed_by_foreman, n_name as city, r_name as state,
               cast(o_custkey % 100 as varchar) as zip, c_name as address
        from lineitem
        left join orders on l_orderkey = o_orderkey left join part on l_partkey = p_partkey
        left join supplier on l_suppkey = s_suppkey left join customer on o_custkey = c_custkey
        left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""",
    "appointment": f"""
        select cast(event_id as varchar) as id,
               case when event_id % 13 = 0 then null else cast(user_id as varchar) end as lead_id,
               {EVENT_DAY} as start_on,
               case event_id % 97 when 0 then '' when 1 then 'not a date' when 2 then null
                    else cast({EVENT_DAY} as varchar) || 'T' || strftime(ts, '%H:%M:%S') end as set_on,
               case when event_id % 5 = 0 then cast({EVENT_DAY} + 1 as varchar) || 'T' || strftime(ts, '%H:%M:%S') end as canceled_on,
               event_id % 10 = 0 as canceled,
               case event_type when 'signup' then 'New' when 'view' then 'Reset' when 'click' then 'rehash'
                    when 'error' then 'Radon CRM Pickup' else 'WCC' end as appt_type,
               {category('event_id')} as category, {SOURCE_TYPE} as source_type,
               case when user_id % 2 = 0 then ' Supplier#' || lpad(cast(user_id % 100 as varchar), 9, '0')
                    else 'SUPPLIER#' || lpad(cast(user_id % 100 as varchar), 9, '0') end as rep,
               'Supplier#' || lpad(cast(user_id % 100 as varchar), 9, '0') as rep_consolidated,
               case event_id % 4 when 0 then 'Service' when 1 then 'SALES' else 'Sales' end as rep_dept,
               case when event_id % 7 = 0 then null else cast(user_id % 120 as varchar) end as set_by,
               (case when event_id % 2 = 0 then 'Lead ' else 'LEAD ' end) || cast(user_id % 5 as varchar) as team_lead,
               case when event_id % 11 = 0 then null else event_id % 3 end as issued,
               least(event_id % 3, 1) as issued_unique, event_id % 2 as quoted,
               case when event_id % 4 = 0 then 1 else 0 end as sold,
               n_name as city, r_name as state, cast(user_id % 100 as varchar) as zip, c_name as address
        from events left join customer on user_id = c_custkey
        left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""",
    "lead": f"""
        select cast(c_custkey as varchar) as id,
               case when c_custkey % 11 = 0 then null when c_custkey % 13 = 0 then cast(c_custkey + 1000000000 as varchar)
                    else cast(c_custkey as varchar) end as prospect_id,
               case when c_custkey % 101 = 0 then null
                    else date '1999-01-01' + cast((c_custkey % 30) + (c_custkey % 7 - 4) * 365 as integer) end as taken_on,
               {category('c_custkey')} as category, {SOURCE_TYPE} as source_type
        from customer""",
    "prospect": """
        select cast(c_custkey as varchar) as id,
               case c_custkey % 8 when 0 then 'SPAM call' when 1 then 'Out of area' when 2 then 'old: bad or old DATA'
                    when 3 then 'Price' else null end as not_qualified_reason
        from customer""",
    "disq": """
        select id from prospect
        where not_qualified_reason ilike '%bad or old data%' or not_qualified_reason ilike '%spam%'
           or not_qualified_reason ilike '%not the type of work we do%' or not_qualified_reason ilike '%out of area%'""",
    "staff": """
        select cast(s_suppkey as varchar) as id, s_name as name, n_name as team_lead,
               date '1994-06-01' + cast(s_suppkey % 2000 as integer) as start_on,
               case s_suppkey % 4 when 0 then 'Manager' when 1 then 'manager' when 2 then 'Installer' end as title
        from supplier left join nation on s_nationkey = n_nationkey""",
    "project": f"""
        select cast(o_orderkey as varchar) as id, cast(o_orderdate as date) as start_on, cast(o_orderdate as date) as sold_on,
               case when o_orderstatus = 'F' then cast(last_ship as date) end as completed_on,
               case o_orderstatus when 'P' then 'Canceled' when 'O' then 'Active'
                    else case when o_orderkey % 3 = 0 then 'active' else 'Completed' end end as status,
               case o_orderpriority when '5-LOW' then '021 - SERVICE work' when '4-NOT SPECIFIED' then null
                    else '010 - Install' end as job_type,
               cast(100.0 as double) * closed_lines / order_lines as pct_complete,
               {m('quantity')} as value_earned, {m('open_amount')} as value_to_complete,
               o_orderpriority as category, 'Foreman ' || cast(first_supplier % 50 as varchar) as foreman,
               'Supplier#' || lpad(cast(first_supplier as varchar), 9, '0') as rep,
               n_name as city, r_name as state, cast(o_custkey % 100 as varchar) as zip, c_name as address
        from orders
        left join (select l_orderkey, max(l_shipdate) as last_ship,
                          sum(case when l_linestatus = 'F' then 1 else 0 end) as closed_lines, count(*) as order_lines,
                          sum({m('l_quantity')}) as quantity, min(l_suppkey) as first_supplier,
                          sum(case when l_linestatus = 'O' then {m('l_extendedprice')} else {m('0')} end) as open_amount
                   from lineitem group by l_orderkey) l on o_orderkey = l_orderkey
        left join customer on o_custkey = c_custkey
        left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""",
    "source_cost": f"""
        select s_name as name, cast(l_suppkey as varchar) as marketing_source_id, p_type as category,
               cast(l_shipdate as date) as paid_on, {m('l_extendedprice * l_tax')} as amount
        from lineitem left join supplier on l_suppkey = s_suppkey left join part on l_partkey = p_partkey""",
    "marketing_source": """
        select cast(s_suppkey as varchar) as id,
               case s_suppkey % 5 when 0 then 'Building' when 1 then 'AUTOMOBILE' when 2 then 'HOUSEHOLD'
                    when 3 then 'TV' end as source_type
        from supplier""",
    "order_year": f"""
        select cast(year(o_orderdate) as integer) as year, cast(sum({m('o_totalprice')}) as double) as amount,
               cast(count(*) as double) as orders,
               cast(sum(case when o_orderstatus = 'F' then 1 else 0 end) as double) as done,
               cast(sum(case when o_orderstatus = 'O' then 1 else 0 end) as double) as opened
        from orders group by 1""",
    "yearly_goals": """
        select year, type, amount * factor as prod, opened * 1000 * factor as service, amount / 2 * factor as std,
               amount / 3 * factor as prod_prod, orders / 10 * factor as crew_goals, opened * factor as service_stop,
               done * factor as service_prod_stop, done * 500 * factor as service_prod_sale, orders * factor as sale_count,
               amount * factor as sold_amount, done / 7 * factor as wcc
        from order_year, (select 'goal' as type, cast(1.1 as double) as factor
                          union all select 'Target', cast(1.25 as double)) t""",
    "rates": """
        select 100 * (o2 + o1 / 2) / o1 as leads_taken, 100 * (d1 + o1 / 3) / o1 as leads_nd,
               100 * (o2 + o1 / 4) / o1 as appointment_set, 100 * (d1 + o1 / 5) / o1 as appointment_canceled,
               100 * (o2 + o1 / 6) / o1 as appointment_issued, 100 * (d1 + o1 / 7) / o1 as sales_issued,
               100 * (o2 + o1 / 8) / o1 as quoted, 100 * (d1 + o1 / 9) / o1 as sale_sold,
               100 * (o2 + o1 / 10) / o1 as sale_cancelled
        from (select sum(orders) as o1, sum(done) as d1, sum(opened) as o2 from order_year) s""",
    "monthly_distribution": f"""
        select mm.year, mm.month, mm.value / nullif(y.value, 0) as value, mm.sales_value / nullif(y.sales_value, 0) as sales_value,
               mm.prod_sale / nullif(y.prod_sale, 0) as prod_sale, mm.service_sale / nullif(y.service_sale, 0) as service_sale,
               mm.prod_prod / nullif(y.prod_prod, 0) as prod_prod, mm.service_prod / nullif(y.service_prod, 0) as service_prod,
               mm.service_wcc / nullif(y.service_wcc, 0) as service_wcc
        from (select cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month,
                     cast(count(*) as double) as value, cast(sum({m('o_totalprice')}) as double) as sales_value,
                     cast(count_if(o_orderstatus = 'F') as double) as prod_sale,
                     cast(count_if(o_orderstatus = 'O') as double) as service_sale,
                     cast(count_if(o_orderpriority = '1-URGENT') as double) as prod_prod,
                     cast(count_if(o_orderpriority = '5-LOW') as double) as service_prod,
                     cast(count_if(o_orderpriority = '2-HIGH') as double) as service_wcc
              from orders group by 1, 2) mm
        join (select cast(year(o_orderdate) as integer) as year,
                     cast(count(*) as double) as value, cast(sum({m('o_totalprice')}) as double) as sales_value,
                     cast(count_if(o_orderstatus = 'F') as double) as prod_sale,
                     cast(count_if(o_orderstatus = 'O') as double) as service_sale,
                     cast(count_if(o_orderpriority = '1-URGENT') as double) as prod_prod,
                     cast(count_if(o_orderpriority = '5-LOW') as double) as service_prod,
                     cast(count_if(o_orderpriority = '2-HIGH') as double) as service_wcc
              from orders group by 1) y on mm.year = y.year""",
    "typed_line": f"""
        select cast(l_shipdate as date) as date, p_type, l_returnflag, l_linestatus,
               {m('l_extendedprice')} as ext, {m('l_extendedprice * l_tax')} as taxed,
               {m('l_extendedprice * l_discount')} as off, {m('l_extendedprice * (1 - l_discount)')} as net
        from lineitem left join part on l_partkey = p_partkey""",
    "category_year": """
        select cast(year(date) as integer) as year, p_type as product_category, cast(count(*) as double) as lines,
               cast(count_if(l_returnflag = 'R') as double) as returned, cast(count_if(l_linestatus = 'F') as double) as closed,
               cast(sum(ext) as double) as amount
        from typed_line group by 1, 2""",
    "product_yearly_goals": """
        select year, product_category, lines as leads_taken, lines - returned as leads_nd, closed as appointment_set,
               returned as appointment_canceled, closed - returned as appointment_issued, lines / 2 as quoted,
               closed / 3 as sale_sold, returned / 4 as sale_cancelled, amount / 50 as marketing, amount as prod,
               amount / 5 as service, amount / 2 as std
        from category_year""",
    "goal_distribution": """
        select year, product_category, lines as leads_nd, closed as issued_unique, lines / 2 as quoted,
               lines - returned as sold, returned as canceled, amount as net, amount / lines as adl,
               closed / 9 as sale_service, amount / 9 as sale_service_net_amt, amount / 20 as marketing
        from category_year""",
    "goal_distribution_name": """
        select cast(year(date) as integer) as year, p_type as product_category, 'Rep ' || l_returnflag || l_linestatus as name,
               cast(sum(ext) as double) as net_sale, cast(count(*) as double) as net_sale_count
        from typed_line group by 1, 2, 3""",
    "leads_nd_daily": "select cast(o_orderdate as date) as date, cast(count(*) as double) as leads_nd from orders group by 1",
    "marketing_daily": "select date, p_type as product_category, off as per_lead_cost, taxed as total_cost from typed_line",
    "sale_rep_prod_cat": """
        select date, lower(p_type) as product_category, off as prod,
               case when l_linestatus = 'O' then ext end as service, net as std
        from typed_line""",
    "actual_prod_cat": """
        select date, 'actual' as type, product_category, lines as leads_taken, lines - returned as leads_nd,
               closed as appointments_set, returned as appointments_cancelled, lines / 2 as appointments_issued_cc,
               lines / 4 as appointments_issued_sale, closed / 2 as quote_issued, lines - returned as sold,
               returned as cancelled
        from (select date, l_linestatus,
                     case when p_type = 'SMALL' and l_linestatus = 'O' then null
                          when l_linestatus = 'F' then lower(p_type) else p_type end as product_category,
                     cast(count(*) as double) as lines, cast(count_if(l_returnflag = 'R') as double) as returned,
                     cast(count_if(l_linestatus = 'F') as double) as closed
              from typed_line group by 1, 2, 3) s""",
    "order_day": f"""
        select cast(o_orderdate as date) as date, cast(count(*) as double) as orders,
               cast(count_if(o_orderstatus = 'F') as double) as done, cast(count_if(o_orderstatus = 'O') as double) as opened,
               cast(sum({m('o_totalprice')}) as double) as amount
        from orders group by 1""",
    "goal_by_date": """
        select date, orders as goal_leads_all, orders / 2 as goal_leads_taken, done as goal_leads_nd,
               opened as goal_appointments_set, orders / 3 as goal_appointments_cancelled,
               orders / 4 as goal_appointments_issued, orders / 5 as goal_quote_issued, done / 2 as goal_sale_sold,
               orders * 0 as goal_sale_cancelled, amount as goal_marketing_expenses
        from order_day""",
    "customer_funnel": """
        select date, 'actual' as type, cast(null as varchar) as sale_rep, p_type as product_category,
               'Source ' || p_type as source_name, 'Internet' as source_type, cast(null as varchar) as team_lead,
               lines as leads_all, lines as leads_taken, lines - returned as leads_nd, closed as appointments_set,
               returned as appointments_cancelled, lines / 3 as appointments_issued, lines / 2 as appointments_issued_cc,
               lines / 4 as appointments_issued_sale, closed / 2 as quote_issued, amount as sold_total,
               lines - returned as sale_sold, returned as sale_cancelled, amount / 8 as sale_cancelled_amount,
               amount / lines as adl, amount / 7 as ads, amount / 11 as marketing_expenses
        from (select date, p_type, cast(count(*) as double) as lines, cast(count_if(l_returnflag = 'R') as double) as returned,
                     cast(count_if(l_linestatus = 'F') as double) as closed, cast(sum(ext) as double) as amount
              from typed_line group by 1, 2) s""",
}

# Roles another role is built on.
NEEDS = {
    "disq": ["prospect"], "yearly_goals": ["order_year"], "rates": ["order_year"],
    "category_year": ["typed_line"], "product_yearly_goals": ["category_year"],
    "goal_distribution": ["category_year"], "goal_distribution_name": ["typed_line"],
    "marketing_daily": ["typed_line"], "sale_rep_prod_cat": ["typed_line"],
    "actual_prod_cat": ["typed_line"], "goal_by_date": ["order_day"], "customer_funnel": ["typed_line"],
}


def ctes(names: list[str]) -> list[str]:
    """CTEs of the named roles and of those they need, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return [f"{name} as ({ROLES[name].strip()})" for name in ordered]
