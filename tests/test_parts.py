"""Roles built part by part, and what their writes leave on disk."""

import time

import pytest

import load_queries
import star_roles
from leadflow.plans import care, location
from leadflow.session import shuffles_dropped
from leadflow.sources.silver import LAYOUTS, write_silver_parts
from star_roles import AS_OF, CALENDAR_AFTER, StarRoles


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """A star schema of some rows; keys repeat, are NULL or have no parent."""
    root = str(tmp_path_factory.mktemp("star"))
    some = lambda n, *columns: spark.range(n).selectExpr(*columns)
    tables = {
        "region": some(2, "cast(id as int) r_regionkey", "concat('R', id) r_name"),
        "nation": some(4, "cast(id as int) n_nationkey", "concat('N', id) n_name", "cast(id % 3 as int) n_regionkey"),
        "customer": some(30, "id c_custkey", "concat('Customer ', id % 5) c_name", "cast(id % 5 as int) c_nationkey",
                         "if(id % 4 = 0, 'MACHINERY', 'BUILDING') c_mktsegment"),
        "supplier": some(10, "id s_suppkey", "concat('Supplier#', id) s_name", "cast(id % 4 as int) s_nationkey"),
        "part": some(10, "id p_partkey", "if(id % 2 = 0, 'PROMO', 'ECONOMY') p_type"),
        "orders": some(60, "if(id % 13 = 0, null, id) o_orderkey", "if(id % 11 = 0, null, id % 33) o_custkey",
                       "substr('OFP', cast(id % 3 as int) + 1, 1) o_orderstatus", "100.0D + id o_totalprice",
                       "cast(date_add(date'1996-01-01', cast(id * 30 as int)) as timestamp) o_orderdate", "'1-URGENT' o_orderpriority"),
        "lineitem": some(200, "if(id % 17 = 0, null, id % 70) l_orderkey", "id % 12 l_partkey", "if(id % 19 = 0, null, id % 12) l_suppkey",
                         "cast(id % 7 as int) l_linenumber", "1.0D + id % 3 l_quantity", "10.0D * id l_extendedprice", "0.1D l_discount",
                         "0.2D l_tax", "substr('RNA', cast(id % 3 as int) + 1, 1) l_returnflag", "if(id % 2 = 0, 'F', 'O') l_linestatus",
                         "cast(date_add(date'1996-01-01', cast(id * 9 as int)) as timestamp) l_shipdate"),
        "events": some(80, "id event_id", "cast(date'2024-01-03' as timestamp) + make_interval(0, 0, 0, cast(id % 20 as int)) ts",
                       "if(id % 9 = 0, null, id % 35) user_id", "if(id % 2 = 0, 'signup', 'view') event_type", "1.0D value"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}.parquet")
    return StarRoles(spark, root)


@pytest.fixture()
def small_parts(monkeypatch):
    monkeypatch.setattr(star_roles, "PART_BYTES", 1)
    monkeypatch.setattr(star_roles, "PARTS", 3)


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("role", sorted(star_roles.SPLIT))
def test_parts_are_the_role(star, small_parts, role):
    parts = list(star.parts(role))
    assert len(parts) == star_roles.PARTS and min(p.count() for p in parts) > 0
    assert sorted(r for p in parts for r in rows(p)) == rows(star(role))


def test_a_part_of_the_sales_shuffles_its_own_orders(star, small_parts):
    plan = next(star.parts("sale"))._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(o_orderkey" in plan and "xxhash64(l_orderkey" in plan


def test_silver_by_parts_gives_the_same_reports(star, small_parts):
    assert star.n_parts("sale") == star_roles.PARTS
    got = load_queries.silver_staff_location(star)
    assert got.count() > 100
    assert rows(got) == rows(location.staff_location(star, AS_OF, CALENDAR_AFTER))
    assert rows(load_queries.silver_customer_care(star)) == rows(care.customer_care(star, AS_OF, CALENDAR_AFTER))
    assert rows(load_queries.silver_customer_care_v2(star)) == rows(care.customer_care_by_staff(star, AS_OF))


def _shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {x for x in (blocks.apply(i).toString() for i in range(blocks.size())) if x.startswith("shuffle_")}


def test_writes_of_parts_leave_no_shuffle_files(star, small_parts, tmp_path):
    spark = star.spark
    before = _shuffle_files(spark)
    write_silver_parts(star.parts("sale"), f"{tmp_path}/sale", LAYOUTS["sale"])
    for _ in range(50):  # they go in the background
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left
    assert spark.read.parquet(f"{tmp_path}/sale").count() == star("sale").count()


def test_the_setting_is_put_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with pytest.raises(KeyError), shuffles_dropped(spark):
        assert spark.conf.get(key) == "true"
        raise KeyError
    assert spark.conf.get(key, None) == before
