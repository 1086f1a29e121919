"""Views kept up by slices: sums per day, region and product that add and take away.

Each slice of facts brings its sums; facts that are replaced later bring theirs once more with the opposite sign. So sums
of any slices, in any order, merge into those of the facts that hold, and the views are made of them without reading a
fact. First and last days come from the days that are left, as a minimum could not be taken back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.functions.exact import mean
from salesflow.functions.parsing import month_key
from salesflow.operators.kpis import partial_sums
from salesflow.operators.reports import region_month_of
from salesflow.operators.star import Star

DAY_KEYS = ["date_vente", "region_id", "produit_id"]
MEASURES = ["total_sales", "operating_profit", "units_sold", "price_per_unit", "operating_margin"]
COUNTS = ["n_rows", *[f"n_{m}" for m in MEASURES]]
SUM = "decimal(38,6)"


def slice_sums(facts: DataFrame, sign: int = 1) -> DataFrame:
    """The sums of some facts; with sign -1 those that take them back."""
    sums = partial_sums(facts, DAY_KEYS, MEASURES, MEASURES)
    return sums.select(*DAY_KEYS, *[(F.col(c) * sign).cast("long").alias(c) for c in COUNTS],
                       *[F.coalesce(F.col(m).cast(SUM) * sign, F.lit(0)).cast(SUM).alias(m) for m in MEASURES])


def merged_sums(slices: DataFrame) -> DataFrame:
    """One row per day, region and product that has sales left."""
    sums = slices.groupBy(*DAY_KEYS).agg(*[F.sum(c).cast("long").alias(c) for c in COUNTS],
                                         *[F.sum(m).cast(SUM).alias(m) for m in MEASURES])
    return sums.where("n_rows > 0")


def _with_nulls(sums: DataFrame) -> DataFrame:
    """Sums of no values are NULL again."""
    return sums.withColumns({m: F.when(F.col(f"n_{m}") > 0, F.col(m)) for m in MEASURES})


def kept_region_month(sums: DataFrame, star: Star) -> DataFrame:
    """The region-month view from merged sums; of the star only the names are read."""
    monthly = sums.withColumn("mois", month_key(F.col("date_vente"))).groupBy("mois", "region_id", "produit_id").agg(
        *[F.sum(c).alias(c) for c in [*COUNTS, *MEASURES]])
    return region_month_of(_with_nulls(monthly), star)


def kept_global_kpis(sums: DataFrame) -> DataFrame:
    """The global row from merged sums."""
    total = sums.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in [*COUNTS, *MEASURES]],
                     F.min("date_vente").alias("date_debut"), F.max("date_vente").alias("date_fin"))
    per = lambda m: mean(F.col(m), F.col(f"n_{m}"))
    return _with_nulls(total).select(
        F.col("n_rows").alias("total_transactions"), F.col("total_sales").alias("ca_total"), F.col("operating_profit").alias("profit_total"),
        (per("operating_margin") * 100).alias("marge_moyenne_pct"), per("units_sold").alias("panier_moyen_unites"), "date_debut", "date_fin")


def kept_sales_by_month(sums: DataFrame, star: Star) -> DataFrame:
    """Sales per month of the days, regions and products that have names."""
    named = sums.join(star.region.select("region_id"), "region_id", "left_semi").join(
        star.produit.select("produit_id"), "produit_id", "left_semi")
    monthly = named.groupBy(month_key(F.col("date_vente")).alias("mois")).agg(F.sum("total_sales").alias("s"), F.sum("n_total_sales").alias("n"))
    return monthly.select("mois", F.when(F.col("n") > 0, F.col("s")).alias("ca_total")).orderBy("mois")
