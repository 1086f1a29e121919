"""Regional sales forecasts by random forest.

The forecast is the mean value of one sale for a month and weekday, not a monthly total.
The features take few values, so the rows are summed per feature combination before the
fit. Each combination is kept in a bounded number of shards, which lets the bootstrap
resample parts of a combination, as it would resample rows, while the size of a fit stays
bounded whatever the number of sales.
"""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.operators.forest import forest_predictions
from salesflow.operators.normalize import calendar_features
from salesflow.operators.split import can_forecast, flag_train, split_points
from salesflow.session import written

FEATURES = ["month_num", "year_num", "day_of_week"]
HORIZON = 3
SHARDS = 16
#: The engine's limit; the trees are meant to be full.
DEPTH = 30


def forecast_training(split: DataFrame, ties: list[str], shards: int = 1) -> DataFrame:
    """Split rows summed per region, side, calendar features and shard.

    Columns: number of rows, mean, sum, sum of squares and sum of squared deviations from
    the mean (`m2_sales`, accumulated around the running mean so that nothing cancels).
    """
    shard = F.pmod(F.xxhash64(*ties), F.lit(shards)).cast("int")
    sales = F.col("total_sales")
    return (
        calendar_features(split)
        .groupBy("region", "is_train", *FEATURES, shard.alias("shard"))
        .agg(
            F.count("*").alias("n_sales"),
            F.sum(sales).alias("sum_sales"),
            F.sum((sales * sales).cast("decimal(38,4)")).alias("sum_squares"),
            (F.var_pop(sales.cast("double")) * F.count("*")).alias("m2_sales"),
        )
        .withColumn("mean_sales", F.col("sum_sales").cast("double") / F.col("n_sales"))
    )


def frame_after(last: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Calendar features of the months after each region's `last_day`, clipped at the month end."""
    ahead = last.select("region", "last_day", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    dated = ahead.withColumn("date_vente", F.add_months("last_day", F.col("step")))
    return calendar_features(dated).select("region", "step", "date_vente", *FEATURES)


def forecast_frame(df: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """The frame to predict, counted from the last sale of each region."""
    return frame_after(df.groupBy("region").agg(F.max("date_vente").alias("last_day")), horizon)


def forecast_sales(df: DataFrame, ties: list[str], trees: int = 100, depth: int = DEPTH, shards: int = SHARDS,
                   seed: int = 42, pooled: bool = False) -> DataFrame:
    """RMSE on the last fifth and three monthly forecasts per eligible region.

    A forest per region, all grown at once whatever their number; with `pooled` one forest over
    all of them, with the region as a further feature. Regions with too few sales are left out.
    """
    spark = df.sparkSession
    # The columns that matter are stored once, as the split reads them in several narrow passes.
    narrow = written(df.select(*dict.fromkeys(["region", "date_vente", "total_sales", *ties])), "sales")
    held = split_points(narrow, ties)
    points = written(held.where(can_forecast()), "points")
    held.unpersist()
    if points.isEmpty():
        return spark.createDataFrame(
            [], "region string, rmse double, forecast_m1 double, forecast_m2 double, forecast_m3 double"
        )
    summed = written(forecast_training(flag_train(narrow, points, ties), ties, shards), "cells")
    future = frame_after(points)
    tested = summed.where("not is_train")
    if pooled:
        bins = max(32, summed.select("year_num").distinct().count(), points.count())
        forest = RandomForestRegressor(
            featuresCol="_x", labelCol="mean_sales", weightCol="n_sales", predictionCol="predicted", numTrees=trees,
            maxDepth=depth, maxBins=bins, featureSubsetStrategy="all", minInstancesPerNode=1, seed=seed,
        )
        return _forecast_table(*_fit_pooled(forest, summed, future))
    cell = ["region", *FEATURES]
    asked = tested.select(*cell).unionByName(future.select(*cell))
    predicted = forest_predictions(summed.where("is_train"), asked, "region", FEATURES, "shard", "n_sales", "sum_sales", trees, depth, seed)
    predicted = written(predicted, "predicted")
    return _forecast_table(tested.join(predicted, cell), future.join(predicted, cell))


def _fit_pooled(forest, summed: DataFrame, future: DataFrame) -> tuple[DataFrame, DataFrame]:
    indexer = StringIndexer(inputCol="region", outputCol="_region").fit(summed)
    assembler = VectorAssembler(inputCols=["_region", *FEATURES], outputCol="_x")
    ready = assembler.transform(indexer.transform(summed))
    ordered = ready.where("is_train").repartition("region").sortWithinPartitions("region", *FEATURES, "shard")
    model = forest.fit(ordered)
    ahead = assembler.transform(indexer.transform(future))
    return model.transform(ready.where("not is_train")), model.transform(ahead)


def region_rmse(tested: DataFrame, digits: int = 2) -> DataFrame:
    """Root mean squared error per region from summed cells and one `predicted` value for each."""
    n = F.col("n_sales").cast("double")
    off = F.col("mean_sales") - F.col("predicted")
    error = F.sqrt(F.sum(n * off * off + F.col("m2_sales")) / F.sum(n))
    return tested.groupBy("region").agg(F.round(error, digits).alias("rmse"))


def _forecast_table(tested: DataFrame, ahead: DataFrame) -> DataFrame:
    rmse = region_rmse(tested)
    steps = list(range(1, HORIZON + 1))
    months = ahead.groupBy("region").pivot("step", steps).agg(F.round(F.first("predicted"), 2))
    return rmse.join(months, "region").select(
        "region", "rmse", *[F.col(str(i)).alias(f"forecast_m{i}") for i in steps]
    )
