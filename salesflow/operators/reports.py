"""Views and report queries over the star schema.

Facts are summed by their ids first and only the sums meet the dimensions, so a report never
shuffles the fact table by a dimension key and a hot member costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.functions.exact import mean, rounded_mean
from salesflow.operators.kpis import KPI_MEANS, KPI_SUMS, monthly_from_partials, monthly_sums, partial_sums, total_mean
from salesflow.operators.star import Star


def _region() -> Column:
    return F.col("region_name").alias("region")


def view_region_month(star: Star) -> DataFrame:
    """Units, sales, mean price, profit and margin per month, region, product and brand."""
    return region_month_of(monthly_sums(star.fact, ["region_id", "produit_id"], KPI_SUMS, KPI_MEANS), star)


def region_month_of(sums: DataFrame, star: Star) -> DataFrame:
    """The same from sums per month, region and product."""
    return (
        sums.join(star.region, "region_id")
        .join(star.produit, "produit_id")
        .groupBy("mois", _region(), F.col("product_name").alias("produit"), F.col("beverage_brand").alias("marque"))
        .agg(
            F.sum("units_sold").alias("total_unites"),
            F.sum("total_sales").alias("total_ca"),
            total_mean("price_per_unit").alias("prix_moyen"),
            F.sum("operating_profit").alias("total_profit"),
            (total_mean("operating_margin") * 100).alias("marge_pct"),
        )
    )


def monthly_kpis(star: Star, fact: DataFrame) -> DataFrame:
    """Monthly KPIs of the given facts under their region and product names."""
    partials = monthly_sums(fact, ["region_id", "produit_id"], KPI_SUMS, KPI_MEANS)
    named = partials.join(star.region, "region_id").join(star.produit, "produit_id")
    return monthly_from_partials(named.withColumns({"region": F.col("region_name"), "product": F.col("product_name")}))


def view_global_kpis(fact: DataFrame) -> DataFrame:
    """One row over all facts; the totals are NULL over an empty table."""
    return fact.agg(
        F.count("*").alias("total_transactions"),
        F.sum("total_sales").alias("ca_total"),
        F.sum("operating_profit").alias("profit_total"),
        (mean(F.sum("operating_margin"), F.count("operating_margin")) * 100).alias("marge_moyenne_pct"),
        mean(F.sum("units_sold"), F.count("units_sold")).alias("panier_moyen_unites"),
        F.min("date_vente").alias("date_debut"),
        F.max("date_vente").alias("date_fin"),
    )


def global_kpis(fact: DataFrame) -> DataFrame:
    """The global row with zeros in place of missing totals."""
    zeroed = ["ca_total", "profit_total", "marge_moyenne_pct"]
    return view_global_kpis(fact).withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zeroed})


def sales_by_region(star: Star) -> DataFrame:
    return (
        partial_sums(star.fact, ["region_id"], ["total_sales", "units_sold"])
        .join(star.region, "region_id")
        .groupBy(_region())
        .agg(F.sum("total_sales").alias("ca"), F.sum("units_sold").alias("unites"))
        .orderBy(F.desc("ca"), "region")
    )


def monthly_by_region(star: Star) -> DataFrame:
    return (
        monthly_sums(star.fact, ["region_id"], ["total_sales"])
        .join(star.region, "region_id")
        .groupBy("mois", _region())
        .agg(F.sum("total_sales").alias("ca"))
        .orderBy("mois", "region")
    )


def top_products(star: Star, n: int = 10) -> DataFrame:
    """The n best-selling products; equal sales are ordered by product and brand."""
    return (
        partial_sums(star.fact, ["produit_id"], ["total_sales", "units_sold"])
        .join(star.produit, "produit_id")
        .groupBy(F.col("product_name").alias("product"), F.col("beverage_brand").alias("brand"))
        .agg(F.sum("total_sales").alias("ca"), F.sum("units_sold").alias("unites"))
        .orderBy(F.desc("ca"), "product", "brand")
        .limit(n)
    )


def margin_by_region(star: Star) -> DataFrame:
    """Mean margin in percent with two digits per region."""
    ratio = rounded_mean(F.sum("operating_margin"), F.sum("n_operating_margin"), 4)
    return (
        partial_sums(star.fact, ["region_id"], [], ["operating_margin"])
        .join(star.region, "region_id")
        .groupBy(_region())
        .agg((ratio * 100).cast("decimal(12,2)").alias("marge_pct"))
        .orderBy(F.desc("marge_pct"), "region")
    )


def sales_by_month(star: Star) -> DataFrame:
    """Sales per month, straight from the facts whose region and product exist."""
    return (
        monthly_sums(star.fact, ["region_id", "produit_id"], ["total_sales"])
        .join(star.region.select("region_id"), "region_id", "left_semi")
        .join(star.produit.select("produit_id"), "produit_id", "left_semi")
        .groupBy("mois")
        .agg(F.sum("total_sales").alias("ca_total"))
        .orderBy("mois")
    )


def sales_by_month_from_view(view: DataFrame) -> DataFrame:
    """The same report, summed over the region-month view."""
    return view.groupBy("mois").agg(F.sum("total_ca").alias("ca_total")).orderBy("mois")


def dq_history(log: DataFrame, order: list[str | Column], n: int = 20) -> DataFrame:
    """The latest n rows of the quality log, with the time of the check if the log has it."""
    stamp = [c for c in ("checked_at",) if c in log.columns]
    return log.orderBy(*order).select("batch_id", "dq_score", "status", "total_rows", *stamp).limit(n)


def forecast_report(forecasts: DataFrame) -> DataFrame:
    return forecasts.select("region", "rmse", "forecast_m1", "forecast_m2", "forecast_m3").orderBy("region")
