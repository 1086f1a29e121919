"""Random forests of all groups at once, as aggregates keyed by (group, tree, node).

Training rows come summed per cell of whole-number features. A tree draws every cell a number of times, decided by a hash
of the cell, the tree and the seed, and all trees of all groups grow together, level by level: sums per value of each
feature give the best cut of every node, and one join sends the rows to their children. The cells to be predicted go down
with the training rows, and only the branches they are in are grown. So the number of jobs depends on the depth of the trees
and neither on the number of groups nor on that of trees, and a (group, tree) never has more rows than the calendar has cells.

Sums are whole numbers and draws are hashes: the result does not depend on the order or the partitions of the rows. The
unit of the sums is a power of ten, a millionth or, where the total of all cells asks for it, as much as keeps 15 digits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.session import written

#: Means of two sides that differ by less than this part of themselves are equal.
SAME = 1e-9
DIGITS = 15


def draws(*parts: Column) -> Column:
    """A Poisson number of mean 1 from the hash of some columns."""
    share = F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))
    upto, terms = 0.0, []
    for k in range(12):
        upto += math.exp(-1) / math.factorial(k)
        terms.append((share >= upto).cast("int"))
    return sum(terms[1:], terms[0])


def units(cells: DataFrame, total: str) -> int:
    """The number of digits behind the point that sums are counted in; negative for digits before it."""
    size = cells.agg(F.sum(F.abs(F.col(total).cast("double")))).first()[0] or 0.0
    return min(6, DIGITS - math.ceil(math.log10(size + 1)))


def bagged(cells: DataFrame, group: str, features: list[str], shard: str, weight: str, total: str, trees: int, seed: int,
           digits: int) -> DataFrame:
    """(group, tree, features, w, s): the cells each tree has drawn, shards of a cell put together again."""
    whole = cells.withColumn("_whole", F.round(F.col(total).cast("double") * 10.0**digits).cast("long"))
    drawn = whole.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    k = draws(F.col(group), *map(F.col, features), F.col(shard), F.col("tree"), F.lit(seed))
    drawn = drawn.withColumn("k", k).where("k > 0")
    return drawn.groupBy(group, "tree", *features).agg(F.sum(F.col("k") * F.col(weight)).alias("w"),
                                                       F.sum(F.col("k") * F.col("_whole")).alias("s"))


def with_cuts(rows: DataFrame, node: list[str], features: list[str]) -> DataFrame:
    """Each row with its node's mean and cut (gain, feature, value): the one that explains most, the first of equals, NULL
    if no two sides differ. `beyond` tells whether the row lies above the cut.

    A row is looked at once per feature; running sums over the rows of a node give the two sides of every cut. All of it
    goes on within the partitions of (group, tree), so nothing is shuffled a second time.
    """
    values = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(c).cast("int").alias("value")) for i, c in enumerate(features)])
    each = rows.withColumn("at", F.explode(values))
    whole = Window.partitionBy(*node, "at.feature")
    upto = whole.orderBy("at.value")  # up to and with all equal values
    sides = each.withColumns({"w_low": F.sum("w").over(upto), "s_low": F.sum("s").over(upto), "w_all": F.sum("w").over(whole),
                              "s_all": F.sum("s").over(whole)})
    w_high = F.col("w_all") - F.col("w_low")
    low = F.try_divide(F.col("s_low").cast("double"), F.col("w_low"))
    high = F.try_divide((F.col("s_all") - F.col("s_low")).cast("double"), w_high)
    gain = F.col("w_low").cast("double") * w_high / F.col("w_all") * (low - high) * (low - high)
    differ = (F.col("w_low") > 0) & (w_high > 0) & (F.abs(low - high) > SAME * F.greatest(F.abs(low), F.abs(high)))
    order = F.when(differ, F.struct(gain.alias("gain"), (-F.col("at.feature")).alias("feature"), (-F.col("at.value")).alias("value")))
    best = sides.withColumn("best", F.max(order).over(Window.partitionBy(*node)))
    cut = F.when(F.col("best").isNotNull(), F.struct((-F.col("best.feature")).alias("feature"), (-F.col("best.value")).alias("value")))
    mine = best.withColumn("cut", cut).where(F.col("at.feature") == F.coalesce("cut.feature", F.lit(0)))
    return mine.select(*rows.columns, "cut", (F.col("s_all").cast("double") / F.col("w_all")).alias("mean"),
                       (F.col("at.value") > F.col("cut.value")).alias("beyond"))


def forest_predictions(cells: DataFrame, asked: DataFrame, group: str, features: list[str], shard: str, weight: str, total: str,
                       trees: int = 100, depth: int = 30, seed: int = 42) -> DataFrame:
    """(group, features, predicted) for every distinct cell in `asked`.

    `cells` has a row per group, cell of the features and shard, with its weight (number of rows) and total. Trees are
    grown until the rows of a node agree or `depth` is reached. A tree that has drawn nothing of a group takes no part; if
    none has drawn anything, the mean of the group stands in. Groups without a training cell get no prediction.
    """
    spark, node = cells.sparkSession, [group, "tree", "node"]
    digits = units(cells, total)
    train = written(bagged(cells, group, features, shard, weight, total, trees, seed, digits), "trees")
    wanted = asked.select(group, *features).distinct().join(train.select(group, "tree").distinct(), group)
    none = [F.lit(0).cast("long").alias("w"), F.lit(0).cast("long").alias("s"), F.lit(True).alias("asked")]
    both = train.select(group, "tree", *features, "w", "s", F.lit(False).alias("asked")).unionByName(
        wanted.select(group, "tree", *features, *none))
    state = both.withColumn("node", F.lit(1).cast("long"))
    found = []
    for level in range(depth + 1):
        cut = with_cuts(state.repartition(group, "tree"), node, features)
        leaf = F.lit(True) if level == depth else F.col("cut").isNull()
        sent = cut.select(
            group, "tree", F.when(leaf, F.col("node")).otherwise(2 * F.col("node") + F.col("beyond").cast("long")).alias("node"),
            *features, "w", "s", "asked", F.when(leaf, F.col("mean")).alias("mean"))
        needed = F.max("asked").over(Window.partitionBy(*node))
        routed = written(sent.withColumn("needed", needed).where("needed").drop("needed"), "level")
        found.append(routed.where("asked AND mean IS NOT NULL").select(group, *features, "mean"))
        state = routed.where("mean IS NULL").drop("mean")
        if level == depth or state.isEmpty():
            break
    means = spark.createDataFrame([], found[0].schema) if not found else found[0]
    for more in found[1:]:
        means = means.unionAll(more)
    # decimals, so that the order of the trees does not matter
    unit = 10.0**digits
    exact = F.sum((F.col("mean") / unit).cast("decimal(38,9)")).cast("double")
    averaged = means.groupBy(group, *features).agg((exact / F.count("*")).alias("found"))
    plain = cells.groupBy(group).agg((F.sum(F.col(total).cast("decimal(38,6)")).cast("double") / F.sum(weight)).alias("plain"))
    return asked.select(group, *features).distinct().join(plain, group).join(averaged, [group, *features], "left").select(
        group, *features, F.coalesce("found", "plain").alias("predicted"))
