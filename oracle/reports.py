"""Oracle SQL of the KPI reports, written fact by fact on its own lines of thought."""

from __future__ import annotations

from .build import AFTER, AS_OF, EXSRC, FIELD, SETS, SVC, VISIT, YEAR_END, days, folded, on_calendar, sql

SALES_VISIT = f"""lower(coalesce(category, '')) <> 'service' and lower(coalesce(source_type, '')) not in {EXSRC}
    and lower(appt_type) in {FIELD} and lower(rep_dept) = 'sales'"""
SALES_DEAL = f"lower(sale_type) not in {SVC} and lower(department) = 'sales'"
SVC_SALE = f"lower(sale_type) in {SVC}"
SVC_VISIT = f"issued <> 0 and lower(coalesce(appt_type, '')) in {VISIT}"
NOT_WORK = "lower(coalesce(category, '')) <> 'service work'"
NEW_SOURCE = "lower(coalesce(source_type, '')) <> 'existing database'"
SET_DAY = "try_cast(split_part(set_on, 'T', 1) as date)"
CANCEL_DAY = "try_cast(split_part(canceled_on, 'T', 1) as date)"
IS_SET = f"case when lower(coalesce(appt_type, '')) in {SETS} and set_by is not null then 1 else 0 end"
IS_CANCELED = f"case when lower(coalesce(appt_type, '')) in {SETS} and canceled then 1 else 0 end"
PROJECT_OK = """lower(status) <> 'canceled' and lower(job_type) <> '021 - service work' and
    ((completed_on >= date '1999-01-01' and completed_on <= date '1999-12-31' and pct_complete > 0)
     or (pct_complete > 0 and pct_complete < 100))"""
SVC_DONE = f"{SVC_SALE} and (lower(completed_by_dept) = 'service dept.' or completed_by_dept is null)"

R: dict[str, str] = {}

R["ads_adl"] = sql(["appointment", "sale"], {
    "a": f"select start_on as date, sum(issued_unique) as issued from appointment where {SALES_VISIT} group by 1",
    "s": f"select sold_on as date, sum(total_sales) as total, sum(sold) as sold, sum(sold_price) as price from sale where {SALES_DEAL} group by 1",
    "k": f"select canceled_date as date, sum(cast(canceled as int)) as n, sum(canceled_amt) as amt from sale where {SALES_DEAL} group by 1",
    "cal": days(),
}, """select cal.date,
        case when issued = 0 then 0 else cast(total - coalesce(amt, 0) as double) / issued end as adl,
        case when price = 0 then 0
             else cast(total - coalesce(amt, 0) as double) / nullif(s.sold - coalesce(k.n, 0), 0) end as ads
      from cal left join a on cal.date = a.date left join s on cal.date = s.date left join k on cal.date = k.date""",
    keys="date", doubles="adl ads")

_STAFF_FACTS = {
    "a": f"select start_on as date, trim(lower(rep)) as staff, category, city, issued_unique, quoted from appointment where {SALES_VISIT}",
    "s": f"select sold_on as date, trim(lower(rep)) as staff, category, city, total_sales, sold, sold_price from sale where {SALES_DEAL}",
    "k": f"select canceled_date as date, trim(lower(rep)) as staff, category, city, cast(canceled as int) as n, canceled_amt from sale where {SALES_DEAL}",
}
R["ads_adl_by_staff"] = sql(["appointment", "sale"], {**_STAFF_FACTS, "u": """
    select date, staff, category, issued_unique, quoted, 0 as sold, 0 as n, 0 as price, 0 as total, 0 as amt from a
    union all select date, staff, category, 0, 0, sold, 0, sold_price, total_sales, 0 from s
    union all select date, staff, category, 0, 0, 0, n, 0, 0, canceled_amt from k""",
    "g": folded(f"(select * from u where date <= {AS_OF} and year(date) >= 1995)", "staff category",
                "issued_unique quoted sold n price total amt")},
    """select date, staff, category as product_category, issued_unique, quoted, sold, n as total_cancelled,
              total as total_sold, amt as total_cancelled_amount,
              case when issued_unique = 0 then 0 else cast(total - coalesce(amt, 0) as double) / issued_unique end as adl,
              case when price = 0 then 0 else cast(total - coalesce(amt, 0) as double) / nullif(sold - coalesce(n, 0), 0) end as ads
       from g""",
    keys="date staff product_category", ints="issued_unique quoted sold total_cancelled",
    doubles="total_sold total_cancelled_amount adl ads")

R["sale_appt"] = sql(["appointment"], {"f": f"""
    select start_on as date, rep as staff, issued, quoted, issued_unique as unique_issued, sold as appt_sold
    from appointment where lower(category) <> 'service' and lower(source_type) not in {EXSRC} and lower(appt_type) in {FIELD}"""},
    f"""select date, staff, coalesce(issued, 0) as issued, coalesce(quoted, 0) as quoted,
               coalesce(unique_issued, 0) as unique_issued, coalesce(appt_sold, 0) as appt_sold
        from ({on_calendar('f', 'staff', 'issued quoted unique_issued appt_sold')}) q""",
    keys="date staff", ints="issued quoted unique_issued appt_sold")

R["sale_sold_canceled"] = sql(["sale"], {"f": f"""
    select rep as staff, coalesce(sold_on, canceled_date) as date,
           case when sold_on is not null then sold else 0 end as sale_sold,
           case when sold_on is not null then sold_price else 0 end as sold_price,
           case when sold_on is not null then total_sales else 0 end as total_sale,
           case when canceled_date is not null then cast(canceled as int) else 0 end as sale_cancelled,
           case when canceled_date is not null then canceled_amt else 0 end as cancelled_amt
    from sale where lower(sale_type) not in {SVC}"""},
    on_calendar("f", "staff", "sale_sold sale_cancelled sold_price cancelled_amt total_sale"),
    keys="date staff", ints="sale_sold sale_cancelled", doubles="sold_price cancelled_amt total_sale")

R["sales_staff_location"] = sql(["appointment", "sale"], {**_STAFF_FACTS, "u": """
    select date, staff, category, city, issued_unique, 0 as sold, 0 as n, 0 as price, 0 as total, 0 as amt from a
    where lower(category) in (select distinct lower(category) from sale)
    union all select date, staff, category, city, 0, sold, 0, sold_price, total_sales, 0 from s
    union all select date, staff, category, city, 0, 0, n, 0, 0, canceled_amt from k"""},
    f"""select date, staff, category as product_category, city as appointment_location,
               coalesce(issued_unique, 0) as issued_unique, coalesce(sold, 0) as sold, coalesce(n, 0) as total_cancelled,
               coalesce(price, 0) as total_price, coalesce(total, 0) as total_sold, coalesce(amt, 0) as total_cancelled_amount
        from ({folded(f"(select * from u where date <= {AS_OF})", "staff category city", "issued_unique sold n price total amt")}) q""",
    keys="date staff product_category appointment_location", ints="issued_unique sold total_cancelled",
    doubles="total_price total_sold total_cancelled_amount")

R["service_ads"] = sql(["appointment", "sale"], {"u": f"""
    select start_on as date, trim(lower(rep)) as staff, issued_unique, 0 as sold, 0 as cancelled, 0 as price, 0 as sold_total, 0 as cancelled_amt
    from appointment where {SVC_VISIT}
    union all select sold_on, trim(lower(rep)), 0, sold, 0, orig_price, total_sales, 0 from sale where {SVC_SALE}
    union all select canceled_date, trim(lower(rep)), 0, 0, cast(canceled as int), 0, 0, canceled_amt from sale where {SVC_SALE}""",
    "g": folded("u", "staff", "issued_unique sold cancelled price sold_total cancelled_amt")},
    """select *, case when issued_unique = 0 then 0 when cancelled_amt is null then cast(sold_total as double) / issued_unique
                      else cast(sold_total - cancelled_amt as double) / issued_unique end as ads from g""",
    keys="date staff", ints="issued_unique sold cancelled", doubles="price sold_total cancelled_amt ads")

R["service_sales"] = sql(["appointment", "sale"], {"u": f"""
    select start_on as date, rep_consolidated as staff, category as product_category, issued_unique, sold, 0 as price, 0 as total_sales, 0 as cancelled_amt
    from appointment where issued <> 0 and lower(appt_type) in {VISIT}
    union all select sold_on, rep, category, 0, 0, sold_price, total_sales, 0 from sale where {SVC_SALE}
    union all select canceled_date, rep, category, 0, 0, 0, 0, canceled_amt from sale where {SVC_SALE}"""},
    f"select *, total_sales - cancelled_amt as net_sales from ({on_calendar('u', 'staff product_category', 'issued_unique sold price total_sales cancelled_amt')}) q",
    keys="date staff product_category", ints="issued_unique sold", doubles="price total_sales cancelled_amt net_sales")

_CARE = "leads_taken leads_nd appointments_set appointments_cancelled"
R["customer_care"] = sql(["lead", "disq", "appointment"], {"u": f"""
    select taken_on as date, category as product_category, source_type, 1 as leads_taken, 0 as leads_nd, 0 as appointments_set, 0 as appointments_cancelled
    from lead where taken_on <= {AS_OF} and lower(source_type) <> 'existing database'
    union all
    select taken_on, coalesce(category, ''), coalesce(source_type, ''), 0, 1, 0, 0 from lead
    where not exists (select 1 from disq where lower(disq.id) = lower(lead.prospect_id)) and {NEW_SOURCE} and {NOT_WORK}
    union all select {SET_DAY}, category, source_type, 0, 0, {IS_SET}, 0 from appointment where {NOT_WORK} and {NEW_SOURCE}
    union all select {CANCEL_DAY}, category, source_type, 0, 0, 0, {IS_CANCELED} from appointment
    where canceled_on is not null and {NOT_WORK} and {NEW_SOURCE}"""},
    f"""select date, product_category, source_type, coalesce(leads_taken, 0) as leads_taken, coalesce(leads_nd, 0) as leads_nd,
               coalesce(appointments_set, 0) as appointments_set, coalesce(appointments_cancelled, 0) as appointments_cancelled,
               coalesce(appointments_set, 0) - coalesce(appointments_cancelled, 0) as appointments_issued
        from ({on_calendar('u', 'product_category source_type', _CARE)}) q""",
    keys="date product_category source_type", ints=_CARE + " appointments_issued")

_FROM = f"cast({AS_OF} - interval 5 year as date)"
R["customer_care_v2"] = sql(["lead", "disq", "appointment", "staff"], {
    "recent": f"select * from appointment where lead_id is not null and {SET_DAY} between {_FROM} and {AS_OF}",
    "touch": """select lead_id, set_by as staff_id from (
        select lead_id, set_by, row_number() over (partition by lead_id order by set_on, id) as rn from recent) t where rn = 1""",
    "owned": f"""
        select l.*, coalesce(s.name, 'Unassigned') as name, s.team_lead,
               exists (select 1 from disq where lower(disq.id) = lower(l.prospect_id)) as bad
        from lead l left join touch t on lower(l.id) = lower(t.lead_id) left join staff s on lower(t.staff_id) = lower(s.id)
        where taken_on between {_FROM} and {AS_OF} and lower(source_type) <> 'existing database'""",
    "u": f"""
        select taken_on as date, name, team_lead, coalesce(category, '') as product_category, coalesce(source_type, '') as source_type,
               1 as leads_taken, 0 as leads_nd, 0 as appointments_set, 0 as appointments_cancelled from owned
        union all select taken_on, name, team_lead, coalesce(category, ''), coalesce(source_type, ''), 0, 1, 0, 0
        from owned where not bad and {NOT_WORK}
        union all select {SET_DAY}, coalesce(s.name, 'Unassigned'), a.team_lead, coalesce(category, ''), coalesce(source_type, ''), 0, 0, {IS_SET}, 0
        from recent a left join staff s on lower(a.set_by) = lower(s.id) where {NOT_WORK} and lower(source_type) <> 'existing database'
        union all select {CANCEL_DAY}, coalesce(s.name, 'Unassigned'), a.team_lead, coalesce(category, ''), coalesce(source_type, ''), 0, 0, 0, {IS_CANCELED}
        from appointment a left join staff s on lower(a.set_by) = lower(s.id)
        where canceled_on is not null and {NOT_WORK} and {NEW_SOURCE} and {CANCEL_DAY} between {_FROM} and {AS_OF}"""},
    f"select *, appointments_set - appointments_cancelled as appointments_issued from ({folded('u', 'name team_lead product_category source_type', _CARE)}) q",
    keys="date name team_lead product_category source_type", ints=_CARE + " appointments_issued")

R["marketing_cost_by_source"] = sql(["source_cost"], {
    "g": folded("(select paid_on as date, name as source, category as product_category, amount as cost from source_cost)",
                "source product_category", "cost"),
    "w": "select date, source, product_category, sum(cost) over (partition by date, lower(source)) as cost from g"},
    f"select date, source, product_category, coalesce(cost, 0) as cost from ({on_calendar('w', 'source product_category', 'cost')}) q",
    keys="date source product_category", doubles="cost")

_KPI_STEPS = {
    "cost": folded("(select paid_on as date, source_type, amount as cost from source_cost sc left join marketing_source t "
                   "on lower(t.id) = lower(sc.marketing_source_id))", "source_type", "cost"),
    "nd": folded(f"""(select taken_on as date, source_type, 1 as leads from lead
        where not exists (select 1 from disq where lower(disq.id) = lower(lead.prospect_id)) and {NEW_SOURCE} and {NOT_WORK})""",
        "source_type", "leads"),
    "cal": days(),
    "leads": "select * from nd where date in (select date from cal)",
    # Cost outside the calendar keeps its amount and loses its day; a day without leads shows once without source.
    "kpi": """
        select case when coalesce(leads.date, cost.date) in (select date from cal) then coalesce(leads.date, cost.date) end as date,
               coalesce(leads.source_type, cost.source_type) as source_type, coalesce(leads, 0) as leads_nd, coalesce(cost, 0) as total_cost
        from leads full join cost on leads.date = cost.date and lower(leads.source_type) = lower(cost.source_type)
        union all
        select date, null, 0, 0 from cal anti join leads using (date)""",
}
_KPI_ROLES = ["source_cost", "marketing_source", "lead", "disq"]
R["marketing_kpi"] = sql(_KPI_ROLES, _KPI_STEPS, "select * from kpi", keys="date source_type", ints="leads_nd", doubles="total_cost")
R["cost_per_lead"] = sql(_KPI_ROLES, _KPI_STEPS, """
    select lower(source_type) as source_type, sum(leads_nd) as leads_nd, sum(total_cost) as total_cost,
           cast(sum(total_cost) as double) / nullif(sum(leads_nd), 0) as cost_per_lead from kpi group by 1""",
    keys="source_type", ints="leads_nd", doubles="total_cost cost_per_lead")
R["return_on_spend"] = sql(["source_cost", "sale"], {
    "a": "select lower(category) as product_category, sum(amount) as total_cost from source_cost group by 1",
    "b": "select lower(category) as product_category, sum(net_sales) as net_sales from sale group by 1"},
    "select a.product_category, total_cost, net_sales, cast(net_sales as double) / nullif(cast(total_cost as double), 0) as roi from a left join b on a.product_category = b.product_category",
    keys="product_category", doubles="total_cost net_sales roi")

R["value_earned"] = sql(["project", "sale"], {
    "p": f"select start_on as date, sum(value_earned) as v from project where {PROJECT_OK} group by 1",
    "s": f"select sold_on as date, sum(net_sales) as v from sale where {SVC_DONE} group by 1",
    "cal": days()},
    """select cal.date, coalesce(p.v, 0) as prod_ve, coalesce(s.v, 0) as service_ve, coalesce(p.v, 0) + coalesce(s.v, 0) as gt_total
       from cal left join p on cal.date = p.date left join s on cal.date = s.date""",
    keys="date", doubles="prod_ve service_ve gt_total")

R["foreman_value_earned"] = sql(["project", "sale"], {
    "u": f"""
        select start_on as date, coalesce(completed_on, {AS_OF}) as completed_date, category as product_category, foreman, value_earned as prod_ve, 0 as service_ve
        from project where {PROJECT_OK}
        union all select sold_on, null, category, completed_by_foreman, 0, net_sales from sale where {SVC_DONE}""",
    "bound": "select case when max(start_on) is null or max(completed_on) is null then null else greatest(max(start_on), max(completed_on)) end as b from project",
    "cal": f"select cast(d as date) as date from bound, range({AFTER} + interval 1 day, bound.b + interval 1 day, interval 1 day) t(d)"},
    """select cal.date, u.completed_date, min(u.product_category) as product_category, min(u.foreman) as foreman,
              coalesce(sum(prod_ve), 0) as prod_ve, coalesce(sum(service_ve), 0) as service_ve,
              coalesce(sum(prod_ve), 0) + coalesce(sum(service_ve), 0) as gt_total
       from cal left join u on cal.date = u.date group by cal.date, u.completed_date, lower(u.product_category), lower(u.foreman)""",
    keys="date completed_date product_category foreman", doubles="prod_ve service_ve gt_total")

_LOC = ("leads_taken leads_nd appointments_set appointments_cancelled appointments_issued_sale quote_issued "
        "sale_sold sale_cancelled")
_PLACE = "coalesce(category, ''), coalesce(city, ''), coalesce(state, ''), coalesce(zip, ''), coalesce(address, ''), null"
_LOC_UNION = f"""
    select taken_on as date, '' as staff, coalesce(category, '') as product_category, cast(null as varchar) as city,
           cast(null as varchar) as state, cast(null as varchar) as zip, '' as location, cast(null as varchar) as title,
           1 as leads_taken, 0 as leads_nd, 0 as appointments_set, 0 as appointments_cancelled,
           0 as appointments_issued_sale, 0 as quote_issued, 0 as sale_sold, 0 as sale_cancelled
    from lead where taken_on <= {AS_OF} and {NEW_SOURCE}
    union all select taken_on, '', coalesce(category, ''), null, null, null, '', null, 0, 1, 0, 0, 0, 0, 0, 0 from lead
    where not exists (select 1 from prospect p where lower(p.id) = lower(lead.prospect_id)) and {NEW_SOURCE} and {NOT_WORK}
    union all select {SET_DAY}, trim(lower(rep)), {_PLACE}, 0, 0, case when lower(appt_type) in {SETS} and set_by is not null then 1 else 0 end, 0, 0, 0, 0, 0
    from appointment where {NOT_WORK} and {NEW_SOURCE}
    union all select {CANCEL_DAY}, trim(lower(rep)), {_PLACE}, 0, 0, 0, {IS_CANCELED}, 0, 0, 0, 0
    from appointment where canceled_on is not null and {NOT_WORK} and {NEW_SOURCE}
    union all select start_on, trim(lower(rep)), {_PLACE}, 0, 0, 0, 0, 0,
           case when lower(appt_type) in {FIELD} then coalesce(quoted, 0) else 0 end, 0, 0 from appointment
    union all select start_on, trim(lower(rep)), {_PLACE}, 0, 0, 0, 0,
           case when not (coalesce(category, '') ilike '%service%') and lower(coalesce(source_type, '')) not in {EXSRC}
                 and lower(coalesce(appt_type, '')) in {FIELD} then coalesce(issued, 0) else 0 end, 0, 0, 0 from appointment
    union all select sold_on, trim(lower(rep)), {_PLACE}, 0, 0, 0, 0, 0, 0, coalesce(sold, 0), 0 from sale where lower(appt_type) in {FIELD}
    union all select canceled_date, trim(lower(rep)), {_PLACE}, 0, 0, 0, 0, 0, 0, 0, coalesce(cast(canceled as int), 0) from sale where lower(appt_type) in {FIELD}
    union all select sold_on, trim(lower(rep)), {_PLACE}, 0, 0, 0, 0, 0, 0, 0, 0 from project
    union all select start_on, '', null, null, null, null, null, title, null, 0, 0, 0, 0, 0, 0, 0 from staff"""
_LOC_KEYS = "staff product_category city state zip location title"
_LOC_STEPS = {"u": _LOC_UNION, "loc": on_calendar("u", _LOC_KEYS, _LOC)}
_LOC_ROLES = ["lead", "prospect", "appointment", "sale", "project", "staff"]
R["staff_location"] = sql(_LOC_ROLES, _LOC_STEPS,
    "select *, appointments_set - appointments_cancelled as appointments_issued_cc from loc",
    keys="date " + _LOC_KEYS, ints=_LOC + " appointments_issued_cc")
R["location_rollup"] = sql(_LOC_ROLES, _LOC_STEPS, """
    select case when level < 4 then state end as state, case when level < 2 then city end as city, case when level < 1 then zip end as zip,
           level, leads_taken, appointments_set, sale_sold, sale_cancelled
    from (select min(state) as state, min(city) as city, min(zip) as zip, grouping(s, c, z) as level, sum(leads_taken) as leads_taken,
                 sum(appointments_set) as appointments_set, sum(sale_sold) as sale_sold, sum(sale_cancelled) as sale_cancelled
          from (select *, lower(state) as s, lower(city) as c, lower(zip) as z from loc) f group by rollup (s, c, z)) r""",
    keys="state city zip", ints="level leads_taken appointments_set sale_sold sale_cancelled")

# -- goals -------------------------------------------------------------------

_DIM = "day(last_day(make_date(cast(g.year as int), cast(m.month as int), 1)))"


def daily(goal: str, metrics: dict[str, tuple[str, str]], keys: str = "", where: str = "", after: str = AFTER) -> str:
    """Goal rows x month shares x days of the month, through a range join on the day."""
    cols = "".join(f", g.{k}" for k in keys.split())
    cols += "".join(f", g.{g} * m.{s} / {_DIM} as {o}" for o, (g, s) in metrics.items())
    first = "make_date(cast(g.year as int), cast(m.month as int), 1)"
    return (f"select d.date{cols} from {goal} g join monthly_distribution m on g.year = m.year "
            f"join ({days(YEAR_END, after)}) d on d.date between {first} and last_day({first}) {where}")


def company(metrics: dict[str, tuple[str, str]]) -> str:
    sums = ", ".join(f"sum({o}) as {o}" for o in metrics)
    rows = daily("yearly_goals", metrics, where="where lower(g.type) <> 'wbi_goal'")
    return sql(["yearly_goals", "monthly_distribution"], {"x": rows},
               f"select date, 'goal' as type, {sums} from x group by date", keys="date type", doubles=" ".join(metrics))


R["crew_weeks_goal"] = company({"crew_goal": ("crew_goals", "prod_prod")})
R["sale_prod_goal"] = company({"prod_sale_amount": ("prod", "prod_sale")})
R["sale_sale_goal"] = company({"sale_count": ("sale_count", "sales_value"), "sale_amount": ("sold_amount", "sales_value")})
R["service_goal"] = company({"service_sale": ("service", "service_sale"), "service_stop": ("service_stop", "service_sale")})
R["service_prod_goal"] = company({"service_prod_stop": ("service_prod_stop", "service_prod"),
                                  "service_prod_sale": ("service_prod_sale", "service_prod")})
R["service_wcc_goal"] = company({"wcc": ("wcc", "service_wcc")})
R["prod_prod_goal"] = sql(["yearly_goals", "monthly_distribution"], {
    "p": daily("yearly_goals", {"prod_goal": ("prod_prod", "prod_prod")}, where="where lower(g.type) <> 'wbi_goal'"),
    "w": daily("yearly_goals", {"crew_goal": ("crew_goals", "prod_prod")}, where="where lower(g.type) <> 'wbi_goal'")},
    "select p.date, 'goal' as type, sum(prod_goal) as prod_goal, sum(crew_goal) as crew_goal from p join w on p.date = w.date group by p.date",
    keys="date type", doubles="prod_goal crew_goal")

_BY_CAT = {"leads_nd": ("leads_nd", "value"),
           **{c: (c, "sales_value") for c in ("issued_unique", "quoted", "sold", "canceled", "net", "adl")},
           **{c: (c, "service_sale") for c in ("sale_service", "sale_service_net_amt")}}
R["goal_by_category"] = sql(["goal_distribution", "monthly_distribution"],
                            {"x": daily("goal_distribution", _BY_CAT, "product_category")}, "select * from x",
                            keys="date product_category", doubles=" ".join(_BY_CAT))
R["goal_marketing_spend"] = sql(["goal_distribution", "monthly_distribution"], {
    "x": daily("goal_distribution", {"leads_count": ("leads_nd", "value"), "expenditure": ("marketing", "value")}, "product_category")},
    "select date, min(product_category) as product_category, 'goal' as type, sum(leads_count) as leads_count, sum(expenditure) as expenditure from x group by date, lower(product_category)",
    keys="date product_category type", doubles="leads_count expenditure")
R["prod_goal"] = sql(["product_yearly_goals", "monthly_distribution"], {
    "x": daily("product_yearly_goals", {"prod_goal": ("prod", "prod_prod")}, "product_category")},
    "select date, min(product_category) as product_category, 'goal' as type, sum(prod_goal) as prod_goal from x group by date, lower(product_category)",
    keys="date product_category type", doubles="prod_goal")
R["sale_amount_goal"] = sql(["goal_distribution_name", "monthly_distribution"], {
    "x": daily("goal_distribution_name", {"goal": ("net_sale", "sales_value"), "net_sale_count": ("net_sale_count", "sales_value")}, "product_category name")},
    "select * from x", keys="date name product_category", doubles="goal net_sale_count")

_MONTHS = "(select unnest(range(1, 13)) as month)"


def even(metrics: dict[str, str]) -> str:
    first = "make_date(cast(g.year as int), cast(m.month as int), 1)"
    cols = ", ".join(f"g.{g} / 12 / day(last_day({first})) as {o}" for o, g in metrics.items())
    return (f"select d.date, g.product_category, {cols} from product_yearly_goals g cross join {_MONTHS} m "
            f"join ({days(YEAR_END)}) d on d.date between {first} and last_day({first})")


_CATEGORY_GOALS = {
    "leads_taken": "leads_taken", "leads_nd": "leads_nd", "appointments_set": "appointment_set",
    "appointments_cancelled": "appointment_canceled", "appointments_issued": "appointment_issued",
    "quote_issued": "quoted", "sold": "sale_sold", "cancelled": "sale_cancelled", "total_cost": "marketing",
    "prod": "prod", "service": "service", "std": "std"}
_REPEATED = ["per_lead_cost", "total_cost", "prod", "service", "std"]
R["product_category"] = sql(["product_yearly_goals", "actual_prod_cat", "marketing_daily", "sale_rep_prod_cat"], {
    "spend": "select date, lower(product_category) as folded, sum(per_lead_cost) as per_lead_cost, sum(total_cost) as total_cost from marketing_daily group by all",
    "revenue": "select date, lower(product_category) as folded, sum(prod) as prod, sum(service) as service, sum(std) as std from sale_rep_prod_cat group by all",
    "steps": """select date, lower(product_category) as folded, min(product_category) as product_category, count(*) as times,
        sum(leads_taken) as leads_taken, sum(leads_nd) as leads_nd, sum(appointments_set) as appointments_set,
        sum(appointments_cancelled) as appointments_cancelled, sum(appointments_issued_cc) as appointments_issued,
        sum(quote_issued) as quote_issued, sum(sold) as sold, sum(cancelled) as cancelled
        from actual_prod_cat group by date, lower(product_category)""",
    # A day's spend and revenue count once for every funnel row of the category.
    "actual": "select * exclude (" + ", ".join(_REPEATED) + "), 'actual' as type, " + ", ".join(
        f"times * coalesce({m}, 0) as {m}" for m in _REPEATED)
    + " from steps left join spend using (date, folded) left join revenue using (date, folded)",
    "goal": even(_CATEGORY_GOALS)},
    f"""select date, type, product_category, {', '.join(f'cast({m} as double) as {m}' for m in _CATEGORY_GOALS)}, cast(per_lead_cost as double) as per_lead_cost from actual
        union all select date, 'goal', product_category, {', '.join(_CATEGORY_GOALS)}, total_cost / nullif(leads_nd, 0) from goal""",
    keys="date type product_category", doubles=" ".join(_CATEGORY_GOALS) + " per_lead_cost")

R["sale_prod_service_cat"] = sql(["sale", "product_yearly_goals"], {
    "p": folded(f"(select foreman_sale_date as date, category as product_category, foreman_basis as prod from sale where lower(sale_type) not in {SVC} and foreman_sale_date is not null)",
                "product_category", "prod"),
    "s": folded(f"""(select sold_on as date, category as product_category,
        case when lower(sale_type) in {SVC} then total_sales else 0 end as service,
        case when lower(sale_type) not in {SVC} then total_sales else 0 end as std from sale)""", "product_category", "service std"),
    "goal": even({"prod": "prod", "service": "service", "std": "std"})},
    """select date, 'actual' as type, product_category, cast(prod as double) as prod, cast(0 as double) as service, cast(0 as double) as std from p
       union all select date, 'actual', product_category, 0, cast(service as double), cast(std as double) from s
       union all select date, 'goal', product_category, prod, service, std from goal""",
    keys="date type product_category", doubles="prod service std")

_MONEY = ["prod", "service", "std"]
_PSS = {
    "marked": f"select *, lower(sale_type) in {SVC} as is_service, lower(sale_type) not in {SVC} as is_standard, lower(department) = 'sales' as is_sales from sale",
    # Each sale is looked at three times: by its production day, its sale day and its cancel day.
    "moves": """select case look when 1 then foreman_sale_date when 2 then sold_on when 3 then canceled_date end as date,
        sum(foreman_basis) filter (look = 1 and is_standard) as prod,
        sum(total_sales) filter (look = 2 and is_service) as service,
        sum(case look when 2 then total_sales when 3 then -canceled_amt end) filter (is_standard and is_sales) as std
        from marked cross join (values (1), (2), (3)) looks(look) group by 1""",
    "exact": "select date, " + ", ".join(f"coalesce({m}, 0) as {m}" for m in _MONEY) + f" from ({days(YEAR_END)}) d left join moves using (date)",
    "actual": "select date, " + ", ".join(f"cast({m} as double) as {m}" for m in _MONEY) + " from exact",
    "months": "select date_trunc('month', date) as first_day, " + ", ".join(f"cast(sum({m}) as double) as {m}" for m in _MONEY) + " from exact group by 1",
    "usual": "select first_day, " + ", ".join(f"avg({m}) over earlier as {m}" for m in _MONEY) + """ from months
        window earlier as (partition by month(first_day) order by first_day rows between 3 preceding and 1 preceding)""",
    "pct": "select first_day, cast(year(first_day) as int) as year, cast(month(first_day) as int) as month, " + ", ".join(
        f"{m} / nullif(sum({m}) over (partition by year(first_day)), 0) * 100 as {m}" for m in _MONEY) + " from usual",
    "goal": "select cast(unnest(range(cast(first_day as timestamp), first_day + interval 1 month, interval 1 day)) as date) as date, " + ", ".join(
        f"{m}" for m in _MONEY) + " from (select first_day, " + ", ".join(
        f"y.{m} * (pct.{m} / 100) / day(last_day(first_day)) as {m}" for m in _MONEY)
        + " from pct join yearly_goals y on y.year = pct.year where lower(y.type) = 'goal') by_month",
    "stacked": """select date, 'actual' as type, prod, service, std from actual
        union all select date, 'goal', prod, service, std from goal""",
}
R["sale_prod_service"] = sql(["sale", "yearly_goals"], _PSS, "select * from stacked", keys="date type", doubles="prod service std")
R["seasonal_share"] = sql(["sale"], {k: v for k, v in _PSS.items() if k not in ("goal", "stacked", "actual")}, "select * from pct",
                          ints="year month", doubles="prod service std")
_VS = ["prod", "service", "std"]
R["kpi_vs_goal"] = sql(["sale", "yearly_goals"], {**_PSS, "g": "select cast(date_trunc('month', date) as date) as month, " + ", ".join(
    f"sum(case when type = '{t}' then {c} end) as {t}_{c}" for c in _VS for t in ("actual", "goal")) + " from stacked group by 1"},
    "select *, " + ", ".join(
        f"case when goal_{c} = 0 then 0 else actual_{c} * 100 / goal_{c} end as pct_{c}, "
        f"case when goal_{c} is null then null when actual_{c} >= goal_{c} then 'met' else 'missed' end as status_{c}" for c in _VS) + " from g",
    keys="month status_prod status_service status_std",
    doubles=" ".join(f"actual_{c} goal_{c} pct_{c}" for c in _VS))

_PCT = ["leads_all", "leads_taken", "leads_nd", "appointments_set", "appointments_cancelled", "appointments_issued",
        "quote_issued", "sale_sold", "sale_cancelled", "marketing_expenses"]
R["customer_funnel_pct"] = sql(["customer_funnel", "goal_by_date"], {
    "y": "select year(date) as year, " + ", ".join(f"sum(goal_{c}) as t_{c}" for c in _PCT) + " from goal_by_date group by 1"},
    "select g.date, " + ", ".join(f"f.{c}, g.goal_{c}, g.goal_{c} / nullif(y.t_{c}, 0) * 100 as pct_{c}" for c in _PCT)
    + " from customer_funnel f left join goal_by_date g on f.date = g.date left join y on year(g.date) = y.year",
    keys="date", doubles=" ".join(f"{c} goal_{c} pct_{c}" for c in _PCT))

_FACT = ("leads_taken leads_nd appointments_set appointments_cancelled appointments_issued_cc appointments_issued_sale "
         "quote_issued sold_total sale_sold sale_cancelled sale_cancelled_amount ads adl")
_CHAIN = """
    select date, leads_nd as raw_nd, round(leads_nd / nullif(b_taken / 100, 0), 5) as lead_taken, round(leads_nd, 5) as step1,
           round(round(leads_nd, 5) * (b_set / 100), 5) as step2,
           round(round(round(leads_nd, 5) * (b_set / 100), 5) * (b_can / 100), 5) as step3,
           round(round(round(leads_nd, 5) * (b_set / 100), 5) * (b_iss / 100), 5) as step4
    from leads_nd_daily, (select leads_taken as b_taken, appointment_set as b_set, appointment_canceled as b_can, appointment_issued as b_iss from rates) b"""
_DAILY = ["leads_taken", "leads_nd", "appointments_set", "appointments_cancelled", "appointments_issued_cc",
          "appointments_issued_sale", "quote_issued", "sale_sold", "sale_cancelled", "adl"]
R["fact_table_goal"] = sql(["leads_nd_daily", "rates", "product_yearly_goals", "goal_distribution", "monthly_distribution", "customer_funnel"], {
    "chain": _CHAIN,
    "months": "select date_trunc('month', date) as first_day, " + ", ".join(f"sum({s}) as {s}" for s in ("lead_taken", "step1", "step2", "step3", "step4"))
    + " from chain group by 1",
    # Everything is constant within a month, so one join at month grain, then the days.
    "by_month": f"""select first_day, p.product_category, lead_taken * p.leads_taken as leads_taken, step1 * p.leads_nd as leads_nd,
        step2 * p.appointment_set as appointments_set, step3 * p.appointment_canceled as appointments_cancelled,
        step4 * p.appointment_issued as appointments_issued_cc, share * d.issued_unique as appointments_issued_sale,
        share * d.quoted as quote_issued, share * d.sold as sale_sold, share * d.canceled as sale_cancelled, share * d.adl as adl
        from (select *, make_date(cast(year as int), cast(month as int), 1) as first_day, sales_value as share from monthly_distribution) m
        join months using (first_day) join product_yearly_goals p on p.year = year(first_day)
        join goal_distribution d on d.year = p.year and lower(d.product_category) = lower(p.product_category)
        where first_day between {AFTER} + interval 1 day and {YEAR_END}""",
    "goal": "select cast(unnest(range(cast(first_day as timestamp), first_day + interval 1 month, interval 1 day)) as date) as date, "
    "product_category, " + ", ".join(f"{m} / day(last_day(first_day)) as {m}" for m in _DAILY) + " from by_month"},
    """select date, 'goal' as type, null as sale_rep, product_category, null as source_name, null as source_type, null as team_lead,
              leads_taken, leads_nd, appointments_set, appointments_cancelled, appointments_issued_cc, appointments_issued_sale,
              quote_issued, 0 as sold_total, sale_sold, sale_cancelled, 0 as sale_cancelled_amount, 0 as ads, adl from goal
       union all
       select date, type, sale_rep, product_category, source_name, source_type, team_lead, leads_taken, leads_nd, appointments_set,
              appointments_cancelled, appointments_issued_cc, appointments_issued_sale, quote_issued, sold_total, sale_sold,
              sale_cancelled, sale_cancelled_amount, ads, adl from customer_funnel""",
    keys="date type sale_rep product_category source_name source_type team_lead", doubles=_FACT)

R["wbi_funnel_steps"] = sql(["customer_funnel", "rates"], {}, """
    select a.date, a.leads_nd, a.leads_nd * (b.leads_nd / 100) as step_taken, step_taken * (b.appointment_set / 100) as step_set,
           step_set * (b.appointment_canceled / 100) as step_canceled, step_canceled * (b.appointment_issued / 100) as step_issued,
           step_issued * (b.sales_issued / 100) as step_issued_sale, step_issued_sale * (b.quoted / 100) as step_quoted,
           step_quoted * (b.sale_sold / 100) as step_sold, step_sold * (b.sale_cancelled / 100) as step_sale_canceled
    from customer_funnel a cross join rates b where year(a.date) = 1999""",
    keys="date", doubles="leads_nd step_taken step_set step_canceled step_issued step_issued_sale step_quoted step_sold step_sale_canceled")
