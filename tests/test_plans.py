"""What the physical plans must and must not contain."""

import re
from datetime import datetime

import pytest

from __spark_entry__ import kpi_queries
from load_queries import load_queries, silver
from leadflow.plans import care, dashboard, location, sales
from leadflow.session import scratch_path
from leadflow.sources.load import incremental_pull
from leadflow.sources.warehouse import PathTables
from star_roles import AS_OF, CALENDAR_AFTER, StarRoles

from .frames import SCHEMAS, day, frame

FOLDER = "/root/testdata/sf0.001"
WRITERS = {"snapshot_replace", "stream_upsert", "stream_daily_funnel", *load_queries()}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in kpi_queries() if n not in WRITERS])
def test_no_cross_join_no_python_no_global_sort(spark, name):
    text = plan(kpi_queries()[name](spark, FOLDER))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow",
                   "rangepartitioning"):
        assert banned not in text, banned


@pytest.fixture(scope="module")
def lake(spark):
    """The roles as flat Parquet tables, as a warehouse would hold them."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    spark.conf.set("spark.sql.debug.maxToStringFields", "500")
    root = scratch_path(spark, "lake")
    for role in SCHEMAS:
        frame(spark, role, []).write.parquet(f"{root}/{role}")
    return PathTables(spark, root)


def ran(df) -> str:
    """The plan that ran, without the ones it began as."""
    df.collect()
    out, skip = [], None
    for line in plan(df).splitlines():
        indent = len(re.match(r"[ :|+\-]*", line)[0])
        if skip is not None and indent >= skip:
            continue
        skip = indent if "== Initial Plan ==" in line else None
        if skip is None:
            out.append(line)
    return "\n".join(out)


def scans(text: str, role: str) -> list[str]:
    """The different scans of a role: a plan also prints the sums that find the days without facts, which are the same."""
    found = [line[line.index("FileScan"):] for line in text.splitlines() if "FileScan" in line and f"/{role}]" in line]
    return list(dict.fromkeys(re.sub(r"#\d+L?", "", line) for line in found))


def test_one_scan_per_table(spark, lake):
    text = plan(sales.ads_adl(lake, day(5), day(1)))
    assert len(scans(text, "sale")) == 1 and len(scans(text, "appointment")) == 1


def test_days_without_facts_cost_no_second_scan(spark):
    """The sums serve the groups and the bitmap of days from one exchange, without a second grouping set."""
    text = ran(sales.sale_appt(StarRoles(spark, FOLDER), AS_OF, CALENDAR_AFTER))
    assert "bitmap_construct_agg" in text and "ReusedExchange" in text and "Expand" not in text
    assert len([x for x in text.splitlines() if "FileScan" in x and "/events.parquet]" in x]) == 1


def test_calendar_and_columns_reach_the_scan(spark, lake):
    scan, = scans(plan(sales.sale_appt(lake, day(5), day(1))), "appointment")
    assert "GreaterThanOrEqual(start_on,2024-03-02)" in scan and "LessThanOrEqual(start_on,2024-03-05)" in scan
    assert "address" not in re.search(r"ReadSchema: (.*)", scan).group(1)


def test_two_facts_push_either_range(spark, lake):
    scan, = scans(plan(sales.ads_adl(lake, day(5), day(1))), "sale")
    assert "Or(" in scan and "sold_on" in scan and "canceled_date" in scan


def test_one_shuffle_for_all_facts(spark, lake):
    """Both tables and three facts meet in one exchange; a day total needs one more for the calendar."""
    assert plan(sales.ads_adl(lake, day(5), day(1))).count("Exchange hashpartitioning") == 2
    assert plan(sales.ads_adl_by_staff(lake, day(5))).count("Exchange hashpartitioning") == 2


def test_qualified_leads_use_an_anti_join(spark):
    assert "LeftAnti" in plan(kpi_queries()["leads_qualified"](spark, FOLDER))


def test_first_touch_needs_no_window(spark):
    text = plan(kpi_queries()["first_touch"](spark, FOLDER))
    assert "Window" not in text and "partial_min" in text


def test_goals_join_no_calendar(spark):
    text = plan(kpi_queries()["sale_sale_goal"](spark, FOLDER))
    assert "Generate explode(" in text and "Range (" not in text


def test_incremental_filter_reaches_the_scan(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").select("o_orderkey", "o_orderdate")
    text = plan(incremental_pull(orders, "o_orderdate", datetime(2000, 1, 1)))
    assert "GreaterThanOrEqual(o_orderdate,2000-01-01T00:00" in text


def test_ranges_reach_the_sale_scan(spark, lake):
    """Facts with different text tests, and a day picked from two columns."""
    for df in (sales.sale_prod_service_actual(lake, day(1), day(5)), sales.sale_sold_canceled(lake, day(5), day(1)),
               dashboard.periods(lake, day(5), day(1))):
        scan, = scans(plan(df), "sale")
        pushed = scan.split("PushedFilters", 1)[1]
        assert pushed.startswith(": [Or(") and "LessThanOrEqual" in pushed


@pytest.fixture(scope="module")
def silver_tables(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the tables are small here
    yield silver(StarRoles(spark, FOLDER), buckets=4)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_typed_days_reach_the_scan(silver_tables):
    """Days that the raw table has as text, of two facts of one scan."""
    for job in (care.customer_care(silver_tables, AS_OF, CALENDAR_AFTER), location.staff_location(silver_tables, AS_OF, CALENDAR_AFTER)):
        scan, = scans(plan(job), "appointment")
        pushed = scan.split("PushedFilters", 1)[1]
        for column in ("set_day", "canceled_day"):
            assert f"GreaterThan({column},1994-12-31)" in pushed and f"LessThanOrEqual({column},2001-08-01)" in pushed
        assert "Or(" in pushed and "set_on" not in scan.split("ReadSchema", 1)[1]


def test_bucketed_leads_meet_prospects_without_exchange(silver_tables):
    """The only exchanges are those of the sums, by day and keys."""
    text = plan(care.customer_care(silver_tables, AS_OF, CALENDAR_AFTER))
    assert "SortMergeJoin [_probe" in text and "Bucketed: true" in text
    assert not [x for x in text.splitlines() if "Exchange hashpartitioning" in x and "probe" in x]
    raw = plan(care.customer_care(StarRoles(silver_tables.spark, FOLDER), AS_OF, CALENDAR_AFTER))
    assert [x for x in raw.splitlines() if "Exchange hashpartitioning" in x and "probe" in x]


def test_rollup_sums_places_alone(spark):
    """One exchange of facts under three keys, one of the rollup; nothing by day, staff or address."""
    text = plan(kpi_queries()["location_rollup"](spark, FOLDER))
    assert text.count("Exchange hashpartitioning(state") == 1
    assert not [x for x in text.splitlines() if "Exchange" in x and ("staff" in x or "location" in x)]


def test_a_report_of_few_columns_scans_once_too(spark):
    """Totals that leave out keys and amounts of the sums below them."""
    for job, table in ((dashboard.weekly_trend, "events"), (dashboard.periods, "lineitem")):
        text = ran(job(StarRoles(spark, FOLDER), AS_OF, CALENDAR_AFTER))
        assert len([x for x in text.splitlines() if "FileScan" in x and f"/{table}.parquet]" in x]) == 1
