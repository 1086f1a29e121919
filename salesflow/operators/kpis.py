"""KPI tables of flat sales records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.functions.exact import mean, rounded_mean
from salesflow.functions.parsing import month_key


def filled_sum(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


KPI_KEYS = ["mois", "region", "product"]
KPI_SUMS = ["total_sales", "operating_profit", "units_sold"]
KPI_MEANS = ["price_per_unit", "operating_margin"]


def partial_sums(df: DataFrame, keys: list[str | Column], sums: list[str], means: list[str] = ()) -> DataFrame:
    """Rows, sums, and for the columns to be averaged sums and non-null counts, per key."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        *[F.sum(c).alias(c) for c in dict.fromkeys([*sums, *means])],
        *[F.count(c).alias(f"n_{c}") for c in means],
    )


def monthly_sums(df: DataFrame, keys: list[str], sums: list[str], means: list[str] = ()) -> DataFrame:
    """Partial sums per month and key; rows are grouped by date, the month text is made per group."""
    month = F.trunc("date_vente", "month").alias("_month")
    sums_by_month = partial_sums(df, [month, *keys], sums, means)
    return sums_by_month.withColumn("mois", month_key(F.col("_month"))).drop("_month")


def total_mean(column: str) -> Column:
    """Mean of a column over partial sums."""
    return mean(F.sum(column), F.sum(f"n_{column}"))


def monthly_from_partials(partials: DataFrame) -> DataFrame:
    """Totals and means per month, region and product; rows without one of the keys are left out."""
    return (
        partials.dropna(subset=KPI_KEYS)
        .groupBy(*KPI_KEYS)
        .agg(
            filled_sum("total_sales").alias("ca_total"),
            filled_sum("operating_profit").alias("profit_total"),
            filled_sum("units_sold").alias("unites_total"),
            total_mean("price_per_unit").alias("panier_moyen"),
            total_mean("operating_margin").alias("marge_moyenne"),
            F.sum("n_rows").alias("nb_transactions"),
        )
        .withColumn("marge_pct", F.col("marge_moyenne") * 100)
    )


def kpi_monthly(df: DataFrame) -> DataFrame:
    """Monthly KPIs of flat records."""
    return monthly_from_partials(monthly_sums(df, ["region", "product"], KPI_SUMS, KPI_MEANS))


def _sales_stats(sales: str) -> dict[str, Column]:
    return {
        "total_sales": F.round(F.sum(sales), 2),
        "avg_sales": rounded_mean(F.sum(sales), F.count(sales), 2),
        "count_transactions": F.count("*"),
        "min_sales": F.round(F.min(sales), 2),
        "max_sales": F.round(F.max(sales), 2),
    }


def kpi_region_month(df: DataFrame, region: str = "region", sales: str = "sales") -> DataFrame:
    """Sales statistics per region and month; records without a readable date form a group of their own."""
    stats = _sales_stats(sales)
    return df.groupBy(region, "mois").agg(*[e.alias(n) for n, e in stats.items()])


def kpi_trend(df: DataFrame, sales: str = "sales") -> DataFrame:
    """Sales statistics per month over all regions."""
    stats = _sales_stats(sales)
    wanted = ["total_sales", "count_transactions", "avg_sales"]
    return df.groupBy("mois").agg(*[stats[n].alias(n) for n in wanted])


def trend_from_regions(kpi: DataFrame) -> DataFrame:
    """Sales total and count per month, rolled up from the region table."""
    return kpi.groupBy("mois").agg(
        F.sum("total_sales").alias("total_sales"),
        F.sum("count_transactions").alias("count_transactions"),
    )


def retailer_features(df: DataFrame) -> DataFrame:
    """Sales, number of sales and mean margin per retailer, complete rows only."""
    return (
        df.dropna(subset=["retailer"])
        .groupBy("retailer")
        .agg(
            filled_sum("total_sales").cast("double").alias("ca_total"),
            F.count("*").alias("nb_transactions"),
            mean(F.sum("operating_margin"), F.count("operating_margin")).alias("marge_moy"),
        )
        .dropna()
    )


def distinct_regions(df: DataFrame) -> DataFrame:
    return df.select("region").distinct()
