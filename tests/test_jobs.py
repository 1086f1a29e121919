"""The jobs from their input to the stored tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from salesflow.plans import jobs
from salesflow.sources import testtables as TT
from salesflow.sources.readers import read_table
from salesflow.streaming import events as EV


def test_stream_job_fills_every_table(spark, small, tmp_path):
    window = Window.orderBy(*TT.FEED_KEYS, "date_vente", "total_sales")
    feed = TT.sales_feed(spark, small).drop("batch_no").withColumn("seq", F.row_number().over(window) - 1)
    root, topic = str(tmp_path / "dwh"), str(tmp_path / "topic")
    EV.publish_files(EV.to_events(feed, "b1"), topic, files=3)
    stream = EV.decode(EV.stream_files(spark, topic, files_per_trigger=1), feed.schema)
    jobs.run_stream_job(stream, root, trees=5)
    read = lambda name: read_table(spark, f"{root}/{name}")
    assert read("dq_log").agg(F.sum("total_rows")).first()[0] == feed.count() == read("fact").count()
    assert read("kpis_agreg").agg(F.sum("ca_total")).first() == read("ventes_clean").agg(F.sum("total_sales")).first()
    assert read("ml_forecasts").count() == 5
    assert read("segments_retailers").select("segment_label").distinct().count() == 3
    types = {f.name: f.dataType.simpleString() for f in read("kpis_agreg").schema.fields}
    assert types["panier_moyen"] == "decimal(10,4)" and types["nb_transactions"] == "int"


def test_dataset_gate_reports_and_decides(spark, small, tmp_path):
    assert jobs.run_dataset_gate(TT.sales_feed(spark, small).dropDuplicates(), str(tmp_path), "clean")
    assert not jobs.run_dataset_gate(TT.dirty_feed(spark, small), str(tmp_path), "dirty")
    reports = {r.run: r.dq_score for r in spark.read.parquet(f"{tmp_path}/dq_reports").collect()}
    assert reports == {"clean": 100, "dirty": 60}
