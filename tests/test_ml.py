"""Split, segments and forecasts."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql import functions as F

from salesflow.operators import forecast as FC
from salesflow.operators import segments as SEG
from salesflow.operators import split as SP
from salesflow.plans.queries import TIES
from salesflow.sources import testtables as TT

SCHEMA = "id long, region string, date_vente date, total_sales decimal(14,2)"


def sales(spark, n, region="N", days=400, effect=True):
    """Sales whose value depends on the weekday."""
    day = F.date_add(F.lit(dt.date(2023, 1, 1)), (F.col("id") % days).cast("int"))
    noise = F.pmod(F.xxhash64("id"), F.lit(20))
    value = (F.weekday(day) * 100 + 50 if effect else F.lit(50)) + noise
    return spark.range(n).select(
        "id", F.lit(region).alias("region"), day.alias("date_vente"), value.cast("decimal(14,2)").alias("total_sales")
    )


def flags(df):
    return {(r.region, r.id): r.is_train for r in df.collect()}


def test_split_equals_row_numbers(spark, small):
    feed = TT.sales_feed(spark, small).select("region", "date_vente", *TIES)
    fast = SP.chronological_split(feed, TIES)
    plain = SP.split_by_row_number(feed, TIES).select(*fast.columns)
    assert fast.exceptAll(plain).count() == 0 and fast.count() == plain.count()


def test_split_of_a_hot_day(spark):
    """Nearly all sales of a region fall on one day."""
    hot = sales(spark, 3000, days=1).union(sales(spark, 100, "S", days=50))
    late = hot.withColumn("date_vente", F.when(F.col("id") < 20, F.lit(dt.date(2022, 1, 1))).otherwise(F.col("date_vente")))
    got = flags(SP.chronological_split(late, ["id"]))
    assert got == flags(SP.split_by_row_number(late, ["id"]))
    assert sum(v for (r, _), v in got.items() if r == "N") == 2400
    assert sum(v for (r, _), v in got.items() if r == "S") == 80


def test_copies_stay_together(spark):
    """A third of all rows are copies of one record."""
    df = sales(spark, 1000, days=1).union(sales(spark, 1, days=1).crossJoin(spark.range(500).toDF("n")).drop("n"))
    got = SP.chronological_split(df, ["id"])
    assert got.count() == 1500
    assert got.where("id = 0").select("is_train").distinct().count() == 1
    assert 1200 <= got.where("is_train").count() <= 1200 + 500


@pytest.mark.parametrize(("n", "train"), [(1, 1), (2, 1), (9, 7), (10, 8), (11, 8)])
def test_split_sizes(spark, n, train):
    assert sum(flags(SP.chronological_split(sales(spark, n), ["id"])).values()) == train


def test_small_groups_are_not_eligible(spark):
    df = sales(spark, 9, "small").union(sales(spark, 10, "large"))
    rows = SP.eligible_groups(df).collect()
    assert [(r.region, r.n_rows, r.n_train) for r in rows] == [("large", 10, 8)]


def test_future_months_are_clipped(spark):
    df = spark.createDataFrame([(1, "N", dt.date(2024, 1, 31), Decimal(1))], SCHEMA)
    got = [(str(r.date_vente), r.month_num, r.day_of_week) for r in FC.forecast_frame(df).orderBy("step").collect()]
    assert got == [("2024-02-29", 2, 3), ("2024-03-31", 3, 6), ("2024-04-30", 4, 1)]


def test_forecast_beats_the_mean(spark):
    df = sales(spark, 2000, "N").union(sales(spark, 9, "tiny")).union(sales(spark, 600, "S", effect=False))
    rows = {r.region: r for r in FC.forecast_sales(df, ["id"], trees=10, depth=8).collect()}
    assert set(rows) == {"N", "S"}
    plain = df.where("region = 'N'").agg(F.stddev_pop("total_sales")).first()[0]
    assert rows["N"].rmse < plain / 5
    for m in ("forecast_m1", "forecast_m2", "forecast_m3"):
        assert 50 <= rows["S"][m] <= 70 and rows["N"][m] < 700


def test_summed_error_equals_the_error_over_rows(spark):
    df = sales(spark, 500)
    split = SP.chronological_split(df, ["id"])
    summed = FC.forecast_training(split, ["id"], shards=4).where("not is_train").withColumn("predicted", F.lit(123.4))
    ahead = FC.forecast_frame(df).withColumn("predicted", F.lit(1.0))
    got = FC._forecast_table(summed, ahead).first().rmse
    error = F.pow(F.col("total_sales").cast("double") - 123.4, 2)
    want = split.where("not is_train").agg(F.sqrt(F.avg(error))).first()[0]
    assert got == round(want, 2)


def test_pooled_forest_serves_many_regions(spark):
    df = sales(spark, 500, "A").union(sales(spark, 500, "B", effect=False))
    rows = {r.region: r for r in FC.forecast_sales(df, ["id"], trees=10, depth=8, pooled=True).collect()}
    assert set(rows) == {"A", "B"} and 50 <= rows["B"].forecast_m1 <= 75


@pytest.mark.parametrize("pooled", [False, True])
def test_more_regions_than_bins(spark, pooled):
    df = sales(spark, 40, "R00")
    for i in range(1, 51):
        df = df.union(sales(spark, 12, f"R{i:02d}", effect=False))
    df = spark.createDataFrame(df.collect(), df.schema).coalesce(2)
    rows = {r.region: r for r in FC.forecast_sales(df, ["id"], trees=1, depth=2, pooled=pooled).collect()}
    assert len(rows) == 51 and all(r.rmse >= 0 for r in rows.values())


def test_constant_sales_have_no_error(spark):
    for value in ("99999.99", "1234567.89"):
        df = sales(spark, 2000).withColumn("total_sales", F.lit(value).cast("decimal(14,2)"))
        assert FC.forecast_sales(df, ["id"], trees=3).first().rmse == 0.0


def test_forecast_of_nothing(spark):
    assert FC.forecast_sales(sales(spark, 5), ["id"]).count() == 0


def test_forecast_is_repeatable(spark):
    df = sales(spark, 300)
    runs = [FC.forecast_sales(df.repartition(n), ["id"], trees=5, depth=6).collect() for n in (2, 5)]
    assert runs[0] == runs[1]


# ── segments ─────────────────────────────────────────────────────────────────
def features(spark, groups):
    rows = [
        (f"{name}{i}", ca + i, n + i % 3, 0.3 + ca / 1e6) for name, ca, n in groups for i in range(20)
    ]
    return spark.createDataFrame(rows, "retailer string, ca_total double, nb_transactions long, marge_moy double")


def test_labels_follow_mean_sales(spark):
    df = features(spark, [("low", 100.0, 5), ("top", 90000.0, 500), ("mid", 30000.0, 100)])
    got = {(r.retailer[:3], r.segment, r.segment_label) for r in SEG.segment_retailers(df, restarts=3).collect()}
    assert got == {("top", 0, "Premium"), ("mid", 1, "Standard"), ("low", 2, "Basique")}
    summary = {r.segment_label: r.nb_retailers for r in SEG.segment_summary(SEG.segment_retailers(df, restarts=3)).collect()}
    assert summary == {"Premium": 20, "Standard": 20, "Basique": 20}


def test_fewer_than_three_retailers(spark):
    df = features(spark, [("a", 1.0, 1)])
    assert SEG.segment_retailers(df.limit(2)).count() == 0
    three = SEG.segment_retailers(df.limit(3), restarts=2)
    assert three.count() == 3 and three.select("segment_label").distinct().count() == 3


def test_constant_feature_scales_to_zero(spark):
    df = features(spark, [("a", 1.0, 1)]).withColumn("marge_moy", F.lit(0.5))
    row = SEG.scaled_features(df).agg(F.max("marge_moy"), F.avg("ca_total"), F.stddev_pop("ca_total")).first()
    assert row[0] == 0.0 and abs(row[1]) < 1e-9 and abs(row[2] - 1) < 1e-9


def test_points_stay_where_they_are(spark, monkeypatch):
    """The passes of k-means bring the centres to the points, whatever the size of these."""
    plans, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or collect(df))
    data = spark.range(3000).select((F.col("id") % 3 * 10 + F.col("id") / 3000).alias("x"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cost, centres = SEG.cluster_centres(data, ["x"], 3, 4, 1)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    passes = [p for p in plans if "near" in p]
    assert passes and not any("SortMergeJoin" in p or "ShuffledHashJoin" in p for p in passes)
    assert [round(c[0], 1) for c in sorted(centres)] == [0.5, 10.5, 20.5]
