"""Retailer segments by k-means."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow import schema as S
from salesflow.session import checkpointed

FEATURES = ["ca_total", "nb_transactions", "marge_moy"]


def scaled_features(features: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """Standardised features: mean 0, population deviation 1, constant columns 0."""
    moments = features.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in columns],
            *[F.stddev_pop(c).alias(f"{c}_std") for c in columns],
        )
    ).scalar()
    scaled = {
        c: F.when(moments[f"{c}_std"] == 0, 0.0).otherwise(
            (F.col(c) - moments[f"{c}_mean"]) / moments[f"{c}_std"]
        )
        for c in columns
    }
    return features.withColumns(scaled)


#: Most iterations; clustering ends sooner once the centres of all starts stay within TOLERANCE.
ITERATIONS = 300
TOLERANCE = 1e-4
#: Rows from which starting centres are drawn.
START_ROWS = 2_000


def _nearest(centres: list[list[float]], columns: list[str]) -> Column:
    """(squared distance, number) of the nearest of some centres; the first of equals."""
    each = [F.struct(sum(((F.col(c) - F.lit(x)) * (F.col(c) - F.lit(x)) for c, x in zip(columns, centre, strict=True)), F.lit(0.0))
                     .alias("distance"), F.lit(i).alias("number")) for i, centre in enumerate(centres)]
    return F.array_min(F.array(*each))


def _starts(data: DataFrame, columns: list[str], k: int, restarts: int, seed: int) -> list[list[list[float]]]:
    """Centres to start from: rows far from those chosen before, drawn from at most START_ROWS rows by their hash."""
    drawn = data.select(*columns).orderBy(F.xxhash64(*columns, F.lit(seed)), *columns).limit(START_ROWS).collect()
    rows, found = [list(r) for r in drawn], []
    for start in range(restarts):
        draw = random.Random(seed + start)
        centres = [draw.choice(rows)]
        while len(centres) < k:
            gaps = [min(sum((x - y) ** 2 for x, y in zip(row, c, strict=True)) for c in centres) for row in rows]
            centres.append(draw.choices(rows, gaps)[0] if any(gaps) else draw.choice(rows))
        found.append(centres)
    return found


def cluster_centres(data: DataFrame, columns: list[str], k: int, restarts: int, seed: int) -> tuple[float, list[list[float]]]:
    """Cost and centres of the best of some starts of k-means.

    Every pass over the rows moves the centres of all starts at once, so the number of passes does not depend on the number
    of starts; a start whose centres stay takes no further part. What comes to the driver is a row per start and cluster. A
    cluster that has lost its rows stays where it is.
    """
    spark = data.sparkSession
    centres = dict(enumerate(_starts(data, columns, k, restarts, seed)))
    costs, moving = {}, set(centres)
    # the centres come as rows, so that every pass runs the same code; they are at most `restarts` rows and go to the points,
    # which stay where they are
    points = data.select(F.array(*columns).alias("point"), F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))).alias("start"))
    gaps = [F.struct(sum(((F.col("point")[j] - F.col("centres")[i][j]) * (F.col("point")[j] - F.col("centres")[i][j])
                          for j in range(len(columns))), F.lit(0.0)).alias("distance"), F.lit(i).alias("number")) for i in range(k)]
    for _ in range(ITERATIONS + 1):
        now = spark.createDataFrame([(s, centres[s]) for s in sorted(moving)], "start int, centres array<array<double>>")
        near = points.join(F.broadcast(now), "start").select("start", "point", F.array_min(F.array(*gaps)).alias("near"))
        summed = near.groupBy("start", "near.number").agg(
            F.count("*").alias("n"), F.sum("near.distance").alias("cost"), *[F.sum(F.col("point")[i]).alias(f"sum_{i}") for i in range(len(columns))])
        moved = dict.fromkeys(moving, 0.0)
        costs |= moved
        for r in summed.collect():  # at most restarts * k rows
            start, before = r["start"], centres[r["start"]][r["number"]]
            costs[start] += r["cost"]
            centre = [r[f"sum_{i}"] / r["n"] for i in range(len(columns))]
            moved[start] = max(moved[start], sum((x - y) ** 2 for x, y in zip(centre, before, strict=True)))
            centres[start][r["number"]] = centre
        moving = {s for s, far in moved.items() if far > TOLERANCE**2}
        if not moving:
            break
    best = min(range(restarts), key=costs.__getitem__)
    return costs[best], centres[best]


def segment_retailers(features: DataFrame, k: int = 3, restarts: int = 10, seed: int = 42) -> DataFrame:
    """Retailers with their segment number and label, best clustering of `restarts` starts.

    Segments are numbered by falling mean sales, so 0 is Premium. Fewer than k retailers
    give no segments at all.
    """
    rows = checkpointed(features)
    if rows.limit(k).count() < k:
        return rows.limit(0).withColumns({"segment": F.lit(0), "segment_label": F.lit("")})
    scaled = {c: f"_scaled_{c}" for c in FEATURES}
    both = scaled_features(rows.withColumns({new: F.col(c) for c, new in scaled.items()}), list(scaled.values())).persist()
    _, centres = cluster_centres(both, list(scaled.values()), k, restarts, seed)
    clustered = both.withColumn("_cluster", _nearest(centres, list(scaled.values()))["number"])
    means = clustered.groupBy("_cluster").agg(F.avg("ca_total").alias("m")).collect()  # k rows
    both.unpersist()
    ranks = {r["_cluster"]: i for i, r in enumerate(sorted(means, key=lambda r: (-r["m"], r["_cluster"])))}
    rank_of = F.create_map(*[F.lit(v) for pair in ranks.items() for v in pair])
    labels = F.array(*[F.lit(v) for v in S.SEGMENT_LABELS])
    return clustered.select(*rows.columns, rank_of[F.col("_cluster")].alias("segment")).withColumn(
        "segment_label", F.get(labels, F.col("segment"))
    )


def segment_summary(segments: DataFrame) -> DataFrame:
    """Number of retailers and mean sales per segment."""
    return segments.groupBy("segment", "segment_label").agg(
        F.count("*").alias("nb_retailers"), F.avg("ca_total").alias("ca_moyen")
    )


def nearest_segments(segments: DataFrame) -> DataFrame:
    """Every retailer with the segment whose centre is nearest in scaled features, to hold against its own."""
    scaled = scaled_features(segments.select("retailer", *FEATURES)).join(segments.select("retailer", "segment"), "retailer")
    centres = scaled.groupBy("segment").agg(*[F.avg(c).alias(f"centre_{c}") for c in FEATURES])
    listed = centres.agg(F.collect_list(F.struct("*")).alias("all")).scalar()  # k rows
    distances = F.transform(F.col("_centres"), lambda c: F.struct(
        sum((F.pow(F.col(f) - c[f"centre_{f}"], F.lit(2)) for f in FEATURES), F.lit(0.0)).alias("distance"),
        c["segment"].alias("segment")))
    return scaled.withColumn("_centres", listed).select("retailer", "segment", F.array_min(distances)["segment"].alias("nearest"))


def segment_report(documents: DataFrame) -> DataFrame:
    """Stored segment documents without their storage id."""
    return documents.drop("_id")
