"""All forests in one fit: as good as one library forest per region, and in as many jobs whatever the regions."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from salesflow.operators import forecast as FC
from salesflow.operators import forest as RF
from salesflow.operators.split import chronological_split


def sales(spark, regions, rows, days=500):
    """Sales whose value depends on the weekday, the month and the region, with some noise."""
    day = F.date_add(F.lit(dt.date(2022, 3, 1)), (F.pmod(F.xxhash64("id"), F.lit(days))).cast("int"))
    region = F.concat(F.lit("R"), F.lpad((F.col("id") % regions).cast("string"), 4, "0"))
    value = F.weekday(day) * 40 + F.month(day) * 15 + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(60)) + F.length(region) * (F.col("id") % regions)
    return spark.range(rows * regions).select(
        "id", region.alias("region"), day.alias("date_vente"), value.cast("decimal(14,2)").alias("total_sales"))


def library_rmse(df, trees):
    """One library forest per region over the same cells."""
    summed = FC.forecast_training(chronological_split(df, ["id"]), ["id"], FC.SHARDS).persist()
    found = {}
    for (region,) in summed.select("region").distinct().collect():
        own = VectorAssembler(inputCols=FC.FEATURES, outputCol="_x").transform(summed.where(F.col("region") == region))
        forest = RandomForestRegressor(featuresCol="_x", labelCol="mean_sales", weightCol="n_sales", predictionCol="predicted", numTrees=trees,
                                       maxDepth=30, maxBins=32, featureSubsetStrategy="all", minInstancesPerNode=1, seed=42)
        model = forest.fit(own.where("is_train").coalesce(1))
        found[region] = FC.region_rmse(model.transform(own.where("not is_train")), 6).first().rmse
    summed.unpersist()
    return found


def test_as_good_as_a_library_forest_per_region(spark):
    df = sales(spark, 3, 4000)
    want = library_rmse(df, 60)
    got = {r.region: r.rmse for r in FC.forecast_sales(df, ["id"], trees=60).collect()}
    assert set(got) == set(want)
    for region, rmse in want.items():
        assert got[region] <= rmse * 1.02 + 0.01


def jobs_of(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    run()
    spark.sparkContext.setJobGroup("others", "others")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_jobs_do_not_grow_with_the_regions(spark):
    few, many = sales(spark, 5, 40), sales(spark, 200, 40)
    runs = {n: jobs_of(spark, f"forest-{n}", lambda df=df: FC.forecast_sales(df, ["id"], trees=3, depth=4).count())
            for n, df in ((5, few), (200, many))}
    assert runs[200] <= runs[5] + 5  # five: adaptive execution may run a stage as a job of its own


def cells(spark, rows):
    return spark.createDataFrame([(*r[:5], Decimal(r[5])) for r in rows], "g string, a int, b int, shard int, n long, total decimal(20,2)")


def test_full_trees_return_what_they_were_given(spark):
    """Without noise within a cell every tree that has drawn a cell gives its mean back; unseen cells follow the cuts."""
    rows = [("x", a, b, s, 3, 3 * (100 * a + b)) for a in range(4) for b in range(3) for s in range(40)]
    rows += [("y", 7, 7, s, 1, 5) for s in range(3)] + [("z", 1, 1, 0, 2, 9)]
    asked = spark.createDataFrame([("x", a, b) for a in range(4) for b in range(3)] + [("x", 9, -5), ("y", 1, 1), ("z", 2, 2), ("w", 1, 1)],
                                  "g string, a int, b int")
    got = {(r.g, r.a, r.b): r.predicted for r in RF.forest_predictions(cells(spark, rows), asked, "g", ["a", "b"], "shard", "n", "total",
                                                                        trees=10).collect()}
    assert all(got["x", a, b] == 100 * a + b for a in range(4) for b in range(3))
    assert got["x", 9, -5] == 300 and got["y", 1, 1] == 5 and got["z", 2, 2] == 4.5
    assert ("w", 1, 1) not in got  # nothing to learn from


def test_a_cut_is_the_best_one(spark):
    values = {0: (5, 10), 1: (1, 12), 2: (4, 30), 3: (2, 33), 4: (3, 90)}
    rows = spark.createDataFrame([("x", 0, 1, a, 0, n, n * v) for a, (n, v) in values.items()],
                                 "g string, tree int, node long, a int, b int, w long, s long")
    found = RF.with_cuts(rows, ["g", "tree", "node"], ["b", "a"]).collect()
    row = found[0]

    def cost(part):
        n = sum(w for w, _ in part)
        mean = sum(w * v for w, v in part) / n
        return sum(w * (v - mean) ** 2 for w, v in part)

    best = min(range(4), key=lambda c: cost([values[a] for a in range(c + 1)]) + cost([values[a] for a in range(c + 1, 5)]))
    assert (row["cut"]["feature"], row["cut"]["value"]) == (1, best)
    assert len(found) == 5 and {r["a"] for r in found if r["beyond"]} == set(range(best + 1, 5))
    assert row["mean"] == pytest.approx(sum(n * v for n, v in values.values()) / sum(n for n, _ in values.values()))


def test_draws_are_poisson(spark):
    counts = {r.k: r["count"] for r in spark.range(200_000).select(RF.draws(F.col("id"), F.lit(7)).alias("k")).groupBy("k").count().collect()}
    for k, share in enumerate([0.36788, 0.36788, 0.18394, 0.06131, 0.01533]):
        assert abs(counts[k] / 200_000 - share) < 0.005
    assert max(counts) <= 12


def test_another_seed_is_another_forest(spark):
    df = sales(spark, 1, 800)
    one, same, two = (FC.forecast_sales(df, ["id"], trees=4, seed=s).collect() for s in (1, 1, 2))
    assert one == same and one != two


def test_huge_totals_keep_their_digits(spark):
    rows = [("x", a, 0, s, 1000, Decimal(10) ** 15 * (a + 1)) for a in range(3) for s in range(30)]
    asked = spark.createDataFrame([("x", a, 0) for a in range(3)], "g string, a int, b int")
    df = spark.createDataFrame(rows, "g string, a int, b int, shard int, n long, total decimal(30,2)")
    got = {r.a: r.predicted for r in RF.forest_predictions(df, asked, "g", ["a", "b"], "shard", "n", "total", trees=5).collect()}
    assert got == {a: pytest.approx(1e12 * (a + 1), rel=1e-12) for a in range(3)}
