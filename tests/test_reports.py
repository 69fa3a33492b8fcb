"""Edge cases of the KPI jobs on hand-written rows."""

from datetime import date

from leadflow.plans import care, location, marketing, production, sales, service

from .frames import day, rows, tables

AFTER, AS_OF = day(1), day(5)


def visit(**over):
    return {"id": "a1", "start_on": day(2), "appt_type": "New", "source_type": "Web", "category": "Basement",
            "rep": "Ann", "rep_consolidated": "Ann", "rep_dept": "Sales", "issued": 1, "issued_unique": 1,
            "quoted": 1, "sold": 0, "set_by": "s1", "canceled": False, **over}


def deal(**over):
    return {"id": "d1", "sold_on": day(2), "sale_type": "Standard", "department": "Sales", "rep": "Ann",
            "category": "Basement", "sold": 1, "canceled": False, "total_sales": 100, "sold_price": 90,
            "orig_price": 110, "net_sales": 95, **over}


def by(df, key, *columns):
    return {r[key]: tuple(None if r[c] is None else float(r[c]) for c in columns) for r in df.collect()}


def test_ads_adl(spark):
    t = tables(spark, appointment=[
        visit(), visit(category=None), visit(source_type=None), visit(category="SERVICE"),
        visit(source_type="existing DATABASE"), visit(appt_type="WCC"), visit(rep_dept=None),
        visit(start_on=day(3), issued_unique=0), visit(start_on=day(4)),
    ], sale=[
        deal(), deal(total_sales=50, sale_type=None), deal(total_sales=70, sale_type="SERVICE opportunity"),
        deal(sold_on=day(3), canceled_date=day(3), canceled=True, canceled_amt=100),
        deal(sold_on=day(4), sold_price=0),
    ])
    got = by(sales.ads_adl(t, AS_OF, AFTER), "date", "adl", "ads")
    assert got[day(2)] == (100 / 3, 100.0)   # three issued, one standard sale
    assert got[day(3)] == (0.0, None)        # nothing issued; one sold less one canceled
    assert got[day(4)] == (100.0, 0.0)       # price is zero
    assert got[day(5)] == (None, None) and len(got) == 4


def test_staff_names_meet(spark):
    t = tables(spark, appointment=[visit(rep=" ANN "), visit(rep=None)], sale=[deal(rep="ann"), deal(sold_on=date(2018, 12, 31))])
    got = sales.ads_adl_by_staff(t, AS_OF)
    assert rows(got, "date", "staff", "issued_unique", "sold", "adl") == [
        (day(2), None, 1, 0, 0.0), (day(2), "ann", 1, 1, 100.0)]


def test_sale_appt_drops_unknowns(spark):
    t = tables(spark, appointment=[visit(), visit(rep="ANN", issued=None), visit(category=None), visit(source_type=None)])
    got = sales.sale_appt(t, day(3), AFTER)
    assert rows(got, "date", "staff", "issued", "quoted") == [(day(2), "ANN", 1, 2), (day(3), None, 0, 0)]


def test_canceled_lands_on_sold_day_here(spark):
    sold = [deal(canceled_date=day(4), canceled=True, canceled_amt=100),
            deal(sold_on=None, canceled_date=day(3), canceled=True, canceled_amt=7),
            deal(sale_type=None), deal(sold_on=None)]
    got = sales.sale_sold_canceled(tables(spark, sale=sold), AS_OF, AFTER)
    assert rows(got, "date", "staff", "sale_sold", "sale_cancelled", "total_sale", "cancelled_amt") == [
        (day(2), "Ann", 1, 1, 100.0, 100.0), (day(3), "Ann", 0, 1, 0.0, 7.0),
        (day(4), None, None, None, None, None), (day(5), None, None, None, None, None)]


def test_location_needs_a_sale_of_the_category(spark):
    t = tables(spark, appointment=[visit(), visit(category="Crawl"), visit(category=None)],
               sale=[deal(category="BASEMENT", city="X"), deal(sold_on=None), deal(sold_on=day(9))])
    got = sales.sales_staff_location(t, AS_OF)
    assert rows(got, "date", "product_category", "appointment_location", "issued_unique", "sold") == [
        (day(2), "BASEMENT", "X", 0, 1), (day(2), "Basement", None, 1, 0)]


def test_service_ads_has_a_row_without_date(spark):
    t = tables(spark, appointment=[visit(appt_type="wcc"), visit(appt_type="WCC", issued=0), visit(appt_type="WCC", issued=None)],
               sale=[deal(sale_type="ANNUAL maintenance"), deal(sale_type="Added Protection", canceled_date=day(2),
                                                                canceled=True, canceled_amt=40)])
    got = service.service_ads(t)
    assert rows(got, "date", "issued_unique", "sold", "cancelled", "price", "ads") == [
        (None, 0, 0, 0, 0.0, 0.0), (day(2), 1, 2, 1, 220.0, 160.0)]


def test_service_sales(spark):
    t = tables(spark, appointment=[visit(appt_type="SaniDry Return", rep_consolidated="Bob", sold=1)],
               sale=[deal(sale_type="Annual Maintenance", canceled_date=day(3), canceled_amt=30)])
    got = service.service_sales(t, day(4), AFTER)
    assert rows(got, "date", "staff", "issued_unique", "sold", "total_sales", "net_sales") == [
        (day(2), "Ann", 0, 0, 100.0, 100.0), (day(2), "Bob", 1, 1, 0.0, 0.0),
        (day(3), "Ann", 0, 0, 0.0, -30.0), (day(4), None, None, None, None, None)]


LEADS = [
    {"id": "1", "prospect_id": "p1", "taken_on": day(2), "category": "A", "source_type": "Web"},
    {"id": "2", "prospect_id": "p2", "taken_on": day(2), "category": "A", "source_type": "Web"},      # spam
    {"id": "3", "prospect_id": None, "taken_on": day(2), "category": None, "source_type": None},      # no prospect
    {"id": "4", "prospect_id": "px", "taken_on": day(2), "category": "Service Work", "source_type": "Web"},
    {"id": "5", "prospect_id": "p1", "taken_on": day(2), "category": "A", "source_type": "Existing database"},
    {"id": "6", "prospect_id": "p1", "taken_on": None, "category": "A", "source_type": "Web"},
]
PROSPECTS = [{"id": "P1", "not_qualified_reason": None}, {"id": "p2", "not_qualified_reason": "is SPAM"}]


def test_customer_care(spark):
    t = tables(spark, lead=LEADS, prospect=PROSPECTS, appointment=[
        visit(category="A", set_on="2024-03-02T08:00:00", canceled_on="2024-03-03", canceled=True),
        visit(category="a", source_type="WEB", set_on="2024-03-02", set_by=None),
        visit(category="A", set_on="garbage"), visit(category="service work", set_on="2024-03-02"),
    ])
    got = care.customer_care(t, day(4), AFTER)
    assert rows(got, "date", "product_category", "source_type", "leads_taken", "leads_nd", "appointments_set",
                "appointments_cancelled", "appointments_issued") == [
        (day(2), "", "", 0, 1, 0, 0, 0),
        (day(2), "A", "WEB", 2, 1, 1, 0, 1),
        (day(2), "Service Work", "Web", 1, 0, 0, 0, 0),
        (day(3), "A", "Web", 0, 0, 0, 1, -1),
        (day(4), None, None, 0, 0, 0, 0, 0)]


def test_care_by_staff(spark):
    t = tables(spark, lead=LEADS, prospect=PROSPECTS,
               staff=[{"id": "S1", "name": "Ann", "team_lead": "Lee"}, {"id": "s2", "name": "Bob", "team_lead": "Kim"}],
               appointment=[
                   visit(id="b", lead_id="1", set_on="2024-03-02T08:00", set_by="s2", team_lead="Own", category="A"),
                   visit(id="a", lead_id="1", set_on="2024-03-02T08:00", set_by="s1", team_lead="Own", category="A"),
                   visit(id="0", lead_id="1", set_on="2018-01-01", set_by="s2", team_lead="Own", category="A"),
                   visit(id="c", lead_id=None, set_on="2024-03-02", canceled_on="2024-03-04T1", canceled=True, category=None)])
    got = care.customer_care_by_staff(t, AS_OF)
    assert rows(got, "date", "name", "team_lead", "product_category", "leads_taken", "leads_nd", "appointments_set",
                "appointments_cancelled") == [
        (day(2), "Ann", "Lee", "A", 1, 1, 0, 0),        # first touch by the smaller id
        (day(2), "Ann", "Own", "A", 0, 0, 1, 0),
        (day(2), "Bob", "Own", "A", 0, 0, 1, 0),
        (day(2), "Unassigned", None, "A", 1, 0, 0, 0),  # never touched, and spam
        (day(2), "Unassigned", None, "Service Work", 1, 0, 0, 0),
        (day(4), "Ann", None, "", 0, 0, 0, 1)]


def test_marketing_cost_repeats_the_day_total(spark):
    t = tables(spark, source_cost=[
        {"name": "TV", "category": "A", "paid_on": day(2), "amount": 10},
        {"name": "tv", "category": "B", "paid_on": day(2), "amount": 5},
        {"name": "Ads", "category": "a", "paid_on": day(1), "amount": 99}])
    assert rows(marketing.marketing_cost_by_source(t, day(3), AFTER), "date", "source", "product_category", "cost") == [
        (day(2), "TV", "A", 15.0), (day(2), "tv", "B", 15.0), (day(3), None, None, 0.0)]
    plain = marketing.marketing_cost_by_source(t, day(3), AFTER, repeat_total=False)
    assert rows(plain, "source", "cost") == [(None, 0.0), ("TV", 10.0), ("tv", 5.0)]


def test_marketing_kpi(spark):
    t = tables(spark, lead=LEADS, prospect=PROSPECTS,
               marketing_source=[{"id": "m1", "source_type": "WEB"}, {"id": "m2", "source_type": "TV"}, {"id": "m3"}],
               source_cost=[
                   {"marketing_source_id": "M1", "paid_on": day(2), "amount": 8},    # meets the leads of the day
                   {"marketing_source_id": "m2", "paid_on": day(2), "amount": 3},    # no leads
                   {"marketing_source_id": "m3", "paid_on": day(2), "amount": 2},    # NULL type never meets
                   {"marketing_source_id": "m1", "paid_on": day(9), "amount": 4},    # outside the calendar
                   {"marketing_source_id": "m1", "paid_on": None, "amount": 6}])
    got = marketing.marketing_kpi(t, day(3), AFTER)
    assert rows(got, "date", "source_type", "leads_nd", "total_cost") == [
        (None, "WEB", 0, 4.0), (None, "WEB", 0, 6.0), (day(2), None, 0, 2.0), (day(2), None, 1, 0.0),
        (day(2), "TV", 0, 3.0), (day(2), "Web", 1, 8.0), (day(3), None, 0, 0.0)]


def project(**over):
    return {"id": "1", "start_on": day(2), "status": "Active", "job_type": "010", "pct_complete": 50.0,
            "value_earned": 10, "value_to_complete": 7, "category": "A", "foreman": "Fred", **over}


PROJECTS = [
    project(), project(completed_on=day(3), pct_complete=100.0), project(completed_on=day(3, year=2023), pct_complete=100.0),
    project(pct_complete=100.0), project(pct_complete=0.0), project(status="CANCELED"),
    project(job_type="021 - SERVICE work"), project(job_type=None), project(completed_on=day(3, year=2023), pct_complete=99.0),
]


def test_value_earned(spark):
    t = tables(spark, project=PROJECTS, sale=[
        deal(sale_type="Annual Maintenance", completed_by_dept="SERVICE Dept."), deal(sale_type="Annual Maintenance"),
        deal(sale_type="Annual Maintenance", completed_by_dept="Other"), deal()])
    got = production.value_earned(t, day(3), 2024, AFTER)
    assert rows(got, "date", "prod_ve", "service_ve", "gt_total") == [(day(2), 30.0, 190.0, 220.0), (day(3), 0.0, 0.0, 0.0)]


def test_foreman_value_earned(spark):
    t = tables(spark, project=PROJECTS)
    got = production.foreman_value_earned(t, AS_OF, 2024, AFTER)
    assert rows(got, "date", "completed_date", "foreman", "prod_ve") == [
        (day(2), day(3, year=2023), "Fred", 10.0), (day(2), day(3), "Fred", 10.0), (day(2), AS_OF, "Fred", 10.0),
        (day(3), None, None, 0.0)]


def test_foreman_without_any_completion_has_no_calendar(spark):
    t = tables(spark, project=[project()])
    assert production.foreman_value_earned(t, AS_OF, 2024, AFTER).count() == 0


def test_value_to_complete(spark):
    t = tables(spark, project=PROJECTS)
    assert rows(production.vtc_today(t, AS_OF), "date", "vtc") == [(AS_OF, 28.0)]
    assert rows(production.vtc_today(tables(spark), AS_OF), "date", "vtc") == [(AS_OF, None)]


def test_prod_service_categories_keep_two_rows(spark):
    t = tables(spark, sale=[
        deal(foreman_sale_date=day(2), foreman_basis=5), deal(category="BASEMENT", foreman_sale_date=day(2), foreman_basis=6),
        deal(sale_type=None, foreman_sale_date=day(2), foreman_basis=9), deal(sale_type="SERVICE Opportunity", sold_on=None)])
    assert rows(sales.sale_prod_service_cat(t), "date", "product_category", "prod", "service", "std") == [
        (None, "Basement", 0.0, 100.0, 0.0), (day(2), "BASEMENT", 0.0, 0.0, 200.0), (day(2), "BASEMENT", 11.0, 0.0, 0.0)]


def test_staff_location(spark):
    t = tables(spark, lead=LEADS, prospect=PROSPECTS,
               staff=[{"id": "s1", "start_on": day(2), "title": "Manager"}],
               project=[project(sold_on=day(3), rep=" Ann", city="X")],
               appointment=[visit(set_on="2024-03-02", rep=" Ann", city="X", category="Pool service"),
                            visit(start_on=day(2), rep="ann", city="x", appt_type=None)],
               sale=[deal(appt_type="NEW", city="X", canceled_date=day(3), canceled=True)])
    got = location.staff_location(t, day(3), AFTER)
    assert rows(got, "date", "staff", "product_category", "city", "title", "leads_taken", "leads_nd", "appointments_set",
                "appointments_issued_sale", "quote_issued", "sale_sold", "sale_cancelled") == sorted([
        (day(2), "", "", None, None, 1, 1, 0, 0, 0, 0, 0),             # lead without prospect
        (day(2), "", "A", None, None, 2, 0, 0, 0, 0, 0, 0),            # one prospect on record, one spam: none qualified
        (day(2), "", "Service Work", None, None, 1, 0, 0, 0, 0, 0, 0),
        (day(2), "", None, None, "Manager", None, 0, 0, 0, 0, 0, 0),
        (day(2), "ann", "Pool service", "X", None, 0, 0, 1, 0, 1, 0, 0),
        (day(2), "ann", "Basement", "X", None, 0, 0, 0, 0, 0, 1, 0),
        (day(3), "ann", "Basement", "X", None, 0, 0, 0, 0, 0, 0, 1),
        (day(3), "ann", "A", "X", None, 0, 0, 0, 0, 0, 0, 0),
    ], key=lambda r: tuple((v is not None, str(v)) for v in r))
