from datetime import date

from pyspark.sql import functions as F

from leadflow.plans import pipeline
from leadflow.session import scratch_path
from leadflow.sources.load import Source
from star_roles import StarRoles
from leadflow.sources.warehouse import CatalogTables

from .frames import rows

FOLDER = "/root/testdata/sf0.001"


def test_second_run_upserts_and_keeps(spark):
    root = scratch_path(spark, "pipe")
    first = spark.createDataFrame([("1", "a", 1), ("2", "b", 1)], "id string, t string, seq int")
    second = spark.createDataFrame([("2", "B", 2), ("3", "c", 2)], "id string, t string, seq int")
    first.write.parquet(f"{root}/raw1")
    second.write.parquet(f"{root}/raw2")
    star = StarRoles(spark, FOLDER)
    crew = spark.createDataFrame([(date(2024, 3, 4), 5.0)], "date date, crew_worked double")
    more = spark.createDataFrame([(date(2024, 3, 4), 6.0), (date(2024, 3, 11), 7.0)], "date date, crew_worked double")
    objects = [pipeline.RawObject("staff", ("id",), ("seq",))]

    for n, (log, as_of) in enumerate([(crew, date(2001, 7, 30)), (more, date(2001, 7, 31)), (more, date(2001, 7, 31))], 1):
        run = pipeline.Run(spark, root, f"run{n}", prefix="pipe_")
        manifest = {"staff": Source("parquet", f"{root}/raw{min(n, 2)}")}
        names = pipeline.run_pipeline(run, manifest, objects, {}, star, as_of, log)

    published = CatalogTables(spark, {n: f"pipe_{n}" for n in names})
    assert rows(published("staff"), "id", "t") == [("1", "a"), ("2", "B"), ("3", "c")]
    assert rows(published("weekly_crew_logs"), "date", "crew_worked") == [(date(2024, 3, 4), 6.0), (date(2024, 3, 11), 7.0)]
    assert [r.date for r in published("vtc_dates").orderBy("date").collect()] == [date(2001, 7, 30), date(2001, 7, 31)]
    assert published("stage_actual_prod_cat", "date", "sold").agg(F.count("*")).first()[0] == \
        star("actual_prod_cat").count()


def test_catalog_tables_rename(spark):
    spark.createDataFrame([("1", "x")], "Id string, Kind__c string").createOrReplaceTempView("raw_lead")
    lead = CatalogTables(spark, {"lead": "raw_lead"}, {"lead": {"id": "Id", "source_type": "Kind__c"}})
    assert rows(lead("lead", "id", "source_type"), "id", "source_type") == [("1", "x")]


def test_state_is_found_without_a_catalog(spark):
    """Another session with other views finds the table; the same run again keeps what it has published."""
    root = scratch_path(spark, "state")
    one = spark.createDataFrame([(1,)], "id int")
    pipeline.Run(spark, root, "r1", prefix="state1_").publish("t", one)
    later = pipeline.Run(spark.newSession(), root, "r2", prefix="state2_")
    assert later.old("t").count() == 1 and later.old("other") is None
    assert later.publish("t", later.old("t").union(later.old("t"))).count() == 2
    assert pipeline.Run(spark, root, "r2", prefix="state3_").publish("t", one).count() == 2
    assert pipeline.Run(spark, root, "r3", prefix="state3_").publish("t", one.limit(0)).count() == 2
