"""Edge cases of the reports that set actuals beside goals."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from leadflow.plans import dashboard, goals
from leadflow.sources.warehouse import FrameTables

from .frames import day, rows, tables
from .test_reports import deal


def funnel_row(**over):
    return {"date": day(2), "product_category": "A", "leads_taken": 1.0, "leads_nd": 1.0, "appointments_set": 1.0,
            "appointments_cancelled": 0.0, "appointments_issued_cc": 5.0, "quote_issued": 1.0, "sold": 1.0,
            "cancelled": 0.0, **over}


def test_cost_repeats_per_funnel_row(spark):
    t = tables(spark, stage_actual_prod_cat=[
        funnel_row(), funnel_row(product_category="a"), funnel_row(product_category=None), funnel_row(date=day(3))],
        marketing_daily=[{"date": day(2), "product_category": "a", "per_lead_cost": 2.0, "total_cost": 10.0},
                         {"date": day(2), "product_category": "A", "per_lead_cost": None, "total_cost": 5.0},
                         {"date": day(2), "product_category": None, "per_lead_cost": 1.0, "total_cost": 99.0}],
        sale_rep_prod_cat=[{"date": day(2), "product_category": "A", "prod": 3.0}])
    got = goals.product_category_actual(t)
    assert rows(got, "date", "product_category", "leads_taken", "appointments_issued", "per_lead_cost", "total_cost",
                "prod", "std") == [
        (day(2), None, 1.0, 5.0, 0.0, 0.0, 0.0, 0.0),
        (day(2), "A", 2.0, 10.0, 4.0, 30.0, 6.0, 0.0),
        (day(3), "A", 1.0, 5.0, 0.0, 0.0, 0.0, 0.0)]


def test_category_goal_cost_per_lead(spark):
    t = tables(spark, product_yearly_goals=[
        {"year": 2024, "product_category": "A", "leads_nd": 12.0, "marketing": 24.0},
        {"year": 2024, "product_category": "B", "leads_nd": 0.0, "marketing": 24.0}])
    got = goals.product_category(t, day(5), date(2024, 12, 30))
    assert rows(got, "date", "type", "product_category", "per_lead_cost", "prod") == [
        (date(2024, 12, 31), "goal", "A", 2.0, None), (date(2024, 12, 31), "goal", "B", None, None)]


def test_seasonal_goal(spark):
    """No goal in the first year; later years follow the mean of the earlier ones."""
    sales_ = [deal(sold_on=date(2022, 1, 10), total_sales=300), deal(sold_on=date(2022, 2, 10), total_sales=100),
              deal(sold_on=date(2023, 1, 10), canceled_date=date(2023, 3, 1), canceled_amt=100, total_sales=500)]
    t = tables(spark, sale=sales_, yearly_goals=[
        {"year": y, "type": kind, "std": 8000.0} for y, kind in
        ((2022, "goal"), (2023, "GOAL"), (2024, "goal"), (2024, "target"))])
    got = goals.sale_prod_service(t, day(5), date(2021, 12, 31))
    monthly = got.where("type = 'goal'").groupBy(F.year("date").alias("y"), F.month("date").alias("m")).agg(
        F.sum("std").alias("std")).collect()
    std = {(r.y, r.m): r.std for r in monthly}
    assert std[2022, 1] is None
    assert std[2023, 1] == pytest.approx(6000) and std[2023, 2] == pytest.approx(2000) and std[2023, 3] == 0
    # means for 2024: January 400, February 50, March -50, other months 0
    assert std[2024, 1] == pytest.approx(8000) and std[2024, 2] == pytest.approx(1000)
    assert std[2024, 3] == pytest.approx(-1000)
    actual = got.where("type = 'actual'")
    assert actual.count() == 365 + 365 + 366
    assert rows(actual.where("date = date'2023-03-01'"), "std") == [(-100.0,)]


def test_funnel_pct(spark):
    measures = {m: 1.0 for m in goals.FUNNEL_PCT}
    funnel = spark.createDataFrame(
        [(day(2), *measures.values()), (day(2), *measures.values()), (day(9), *measures.values())],
        "date date, " + ", ".join(f"{m} double" for m in measures))
    goal = spark.createDataFrame([(day(2), *[25.0] * 9, 0.0), (day(3), *[75.0] * 9, 0.0)],
                                 "date date, " + ", ".join(f"goal_{m} double" for m in measures))
    got = goals.customer_funnel_pct(FrameTables(spark, {"customer_funnel": funnel, "goal_by_date": goal}))
    assert rows(got, "date", "leads_nd", "goal_leads_nd", "pct_leads_nd", "pct_marketing_expenses") == [
        (None, 1.0, None, None, None), (day(2), 1.0, 25.0, 25.0, None), (day(2), 1.0, 25.0, 25.0, None)]


def test_fact_table_goal(spark):
    t = tables(spark, leads_nd_daily=[{"date": day(2), "leads_nd": 31.0}, {"date": day(3), "leads_nd": 31.0}],
               yearly_goals=[{"year": 2020, "type": "WBI_goal", "leads_taken": 50.0, "appointment_set": 50.0,
                              "appointment_canceled": 10.0, "appointment_issued": 20.0}],
               product_yearly_goals=[{"year": 2024, "product_category": c, "leads_taken": 0.5, "leads_nd": 1.0,
                                      "appointment_set": 1.0, "appointment_canceled": 1.0, "appointment_issued": 1.0}
                                     for c in ("A", "no sales goal")],
               goal_distribution=[{"year": 2024, "product_category": "a", "sold": 310.0}],
               monthly_distribution=[{"year": 2024, "month": 3, "sales_value": 0.1},
                                     {"year": 2024, "month": 4, "sales_value": 0.9}])
    frames = dict(t._frames)
    frames["stage_customer_funnel"] = spark.createDataFrame(
        [], ", ".join(f"{c} {'date' if c == 'date' else 'string' if c in ('type', 'sale_rep', 'product_category', 'source_name', 'source_type', 'team_lead') else 'double'}"
                      for c in goals.FACT_COLUMNS))
    got = goals.fact_table_goal(FrameTables(spark, frames), day(5), day(30))
    assert rows(got, "date", "product_category", "leads_taken", "leads_nd", "appointments_set",
                "appointments_cancelled", "appointments_issued_cc", "sale_sold", "sold_total") == [
        (day(31), "A", 2.0, 2.0, 1.0, 0.1, 0.2, 1.0, 0.0)]


def test_kpi_vs_goal(spark):
    df = spark.createDataFrame([("x", "actual", 5.0), ("x", "goal", 4.0), ("y", "actual", 1.0), ("y", "goal", 0.0),
                                ("z", "actual", 1.0), ("w", "goal", 3.0)], "k string, type string, n double")
    got = dashboard.kpi_vs_goal(df, ["n"], ["k"])
    assert rows(got, "k", "actual_n", "goal_n", "pct_n", "status_n") == [
        ("w", None, 3.0, None, "missed"), ("x", 5.0, 4.0, 125.0, "met"), ("y", 1.0, 0.0, 0.0, "met"),
        ("z", 1.0, None, None, None)]
