"""Small hand-written tables for the KPI jobs."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from leadflow.sources.warehouse import FrameTables

SCHEMAS = {
    "appointment": "id string, lead_id string, start_on date, set_on string, canceled_on string, appt_type string, "
                   "source_type string, category string, rep string, rep_consolidated string, rep_dept string, "
                   "set_by string, team_lead string, issued int, issued_unique int, quoted int, sold int, "
                   "canceled boolean, city string, state string, zip string, address string",
    "sale": "id string, sold_on date, canceled_date date, sale_type string, department string, rep string, "
            "category string, appt_type string, sold int, canceled boolean, total_sales decimal(18,4), "
            "sold_price decimal(18,4), orig_price decimal(18,4), net_sales decimal(18,4), canceled_amt decimal(18,4), "
            "foreman_sale_date date, foreman_basis decimal(18,4), completed_by_dept string, "
            "completed_by_foreman string, city string, state string, zip string, address string",
    "lead": "id string, prospect_id string, taken_on date, category string, source_type string",
    "prospect": "id string, not_qualified_reason string",
    "staff": "id string, name string, team_lead string, start_on date, title string",
    "project": "id string, start_on date, completed_on date, sold_on date, status string, job_type string, "
               "pct_complete double, value_earned decimal(18,4), value_to_complete decimal(18,4), category string, "
               "foreman string, rep string, city string, state string, zip string, address string",
    "source_cost": "name string, marketing_source_id string, category string, paid_on date, amount decimal(18,4)",
    "marketing_source": "id string, source_type string",
    "yearly_goals": "year int, type string, prod double, service double, std double, prod_prod double, "
                    "crew_goals double, service_stop double, service_prod_stop double, service_prod_sale double, "
                    "sale_count double, sold_amount double, wcc double, leads_taken double, leads_nd double, "
                    "appointment_set double, appointment_canceled double, appointment_issued double, "
                    "sales_issued double, quoted double, sale_sold double, sale_cancelled double",
    "monthly_distribution": "year int, month int, value double, sales_value double, prod_sale double, "
                            "service_sale double, prod_prod double, service_prod double, service_wcc double",
}


def frame(spark, role, rows):
    """A table of the role from dicts; columns left out are NULL."""
    names = [part.split()[0] for part in SCHEMAS[role].replace("(18,4)", "").split(", ")]
    data = [tuple(_money(r.get(n)) if n in _MONEY else r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, SCHEMAS[role])


_MONEY = {"total_sales", "sold_price", "orig_price", "net_sales", "canceled_amt", "foreman_basis",
          "value_earned", "value_to_complete", "amount"}


def _money(value):
    return None if value is None else Decimal(str(value))


def tables(spark, **rows):
    return FrameTables(spark, {role: frame(spark, role, rows.get(role, [])) for role in SCHEMAS})


def day(n, month=3, year=2024):
    return date(year, month, n)


def rows(df, *columns):
    """Rows as a sorted list of tuples; decimals as floats."""
    got = [tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in df.select(*columns).collect()]
    return sorted(got, key=lambda r: tuple((v is not None, str(v)) for v in r))


GOAL_TABLES = {
    "stage_actual_prod_cat": "date date, product_category string, leads_taken double, leads_nd double, "
                             "appointments_set double, appointments_cancelled double, appointments_issued_cc double, "
                             "quote_issued double, sold double, cancelled double",
    "marketing_daily": "date date, product_category string, per_lead_cost double, total_cost double",
    "sale_rep_prod_cat": "date date, product_category string, prod double, service double, std double",
    "product_yearly_goals": "year int, product_category string, leads_taken double, leads_nd double, "
                            "appointment_set double, appointment_canceled double, appointment_issued double, "
                            "quoted double, sale_sold double, sale_cancelled double, marketing double, prod double, "
                            "service double, std double",
    "goal_distribution": "year int, product_category string, issued_unique double, quoted double, sold double, "
                         "canceled double, adl double",
    "leads_nd_daily": "date date, leads_nd double",
}
SCHEMAS.update(GOAL_TABLES)
