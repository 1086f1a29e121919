"""Sales feeds and a star schema over the star tables described in TESTDATA.md and FIXTURES.md."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow import schema as S
from salesflow.operators.star import Star, load_fact, upsert_dimension

ORDERS_PER_BATCH = 25
FEED_KEYS = ["o_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread an input with fewer splits than cores over all cores; larger inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def sales_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean sales records, one per line item, with exact decimal amounts.

    Orders meet their customers first, so line items are shuffled once at most, by order.
    """
    buyers = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("o_orderkey", F.col("c_name").alias("retailer"), F.col("r_name").alias("region"))
    )
    products = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_name").alias("product"),
        F.col("p_brand").alias("beverage_brand"),
        F.col("p_retailprice").cast(S.PRICE).alias("price_per_unit"),
    )
    sales = F.col("l_extendedprice").cast(S.MONEY) * (1 - F.col("l_discount").cast("decimal(4,2)"))
    margin = F.col("l_discount").cast(S.MARGIN) + F.col("l_tax").cast(S.MARGIN)
    lines = spread(table(spark, sf_dir, "lineitem"), "l_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_shipdate").cast("date").alias("date_vente"),
        F.col("l_quantity").cast(S.UNITS).alias("units_sold"),
        sales.cast(S.MONEY).alias("total_sales"),
        margin.cast(S.MARGIN).alias("operating_margin"),
    )
    return (
        lines.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(products, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            *FEED_KEYS,
            F.call_function("div", F.col("o_orderkey"), F.lit(ORDERS_PER_BATCH)).alias("batch_no"),
            "date_vente",
            "region",
            "product",
            "beverage_brand",
            "retailer",
            "units_sold",
            "total_sales",
            "price_per_unit",
            (F.col("total_sales") * F.col("operating_margin")).cast(S.MONEY).alias("operating_profit"),
            "operating_margin",
        )
    )


def dirty_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with missing, negative, outlying and redelivered records."""
    key, batch = F.col("o_orderkey"), F.col("batch_no")
    units = (
        F.when(batch % 10 == 0, None)
        .when((batch % 10 == 3) & (key % 2 == 0), (-F.col("units_sold")).cast(S.UNITS))
        .otherwise(F.col("units_sold"))
    )
    sales = (
        F.when(batch % 10 == 1, None)
        .when(key % 997 == 5, (F.col("total_sales") * 100).cast(S.MONEY))
        .otherwise(F.col("total_sales"))
    )
    copies = F.array_repeat(F.lit(0), F.when(key % 50 == 7, 2).otherwise(1))
    feed = sales_feed(spark, sf_dir)
    return feed.withColumns(
        {
            "region": F.when(batch % 10 != 0, F.col("region")),
            "units_sold": units,
            "total_sales": sales,
            "_copy": F.explode(copies),
        }
    ).drop("_copy")


def text_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as a raw file would carry it: text values under source headers."""
    day, kind = F.col("date_vente"), F.col("o_orderkey") % 5
    date_text = (
        F.when(kind == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(kind == 1, F.date_format(day, "M/d/yyyy"))
        .when(
            kind == 2,
            F.when(F.dayofmonth(day) > 12, F.date_format(day, "dd/MM/yyyy")).otherwise(
                F.date_format(day, "yyyy-MM-dd")
            ),
        )
        .when(kind == 3, F.lit("n/a"))
    )
    gap = F.col("o_orderkey") % 11
    return sales_feed(spark, sf_dir).select(
        *FEED_KEYS,
        F.col("retailer").alias(" Retailer "),
        date_text.alias("Invoice Date"),
        F.when(gap != 2, F.col("region")).alias("Region"),
        F.when(gap != 3, F.col("beverage_brand")).alias("Beverage Brand"),
        F.when((gap != 3) & (gap != 4), F.col("product")).alias("PRODUCT"),
        F.when(gap == 5, "n/a").otherwise(F.col("units_sold").cast("string")).alias("Units Sold"),
        F.when(gap == 6, "n/a").otherwise(F.col("total_sales").cast("string")).alias("Total Sales"),
        F.concat((F.col("operating_margin") * 100).cast("decimal(6,2)").cast("string"), F.lit("%")).alias(
            "Operating Margin"
        ),
    )


def wide_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text feed with sales of three decimals and a few beyond ten million millions."""
    sales, key = F.col("Total Sales"), F.col("o_orderkey")
    wide = F.when(key % 499 == 5, "20000000000000.125").when(
        sales.contains("."), F.concat(sales, (key % 10).cast("string"))).otherwise(sales)
    return text_feed(spark, sf_dir).withColumn("Total Sales", wide)


def star(spark: SparkSession, sf_dir: str, dirty: bool = False) -> Star:
    """Star schema over the tables: dimensions from the master tables, facts from a feed."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_name").alias("product_name"), F.col("p_brand").alias("beverage_brand")
    )
    regions = table(spark, sf_dir, "region").select(F.col("r_name").alias("region_name"))
    if dirty:
        regions = regions.union(regions.sparkSession.range(1).select(F.lit(S.UNKNOWN).alias("region_name")))
    retailers = table(spark, sf_dir, "customer").select(F.col("c_name").alias("retailer_name"))
    dims = {
        "region": upsert_dimension("region", regions),
        "produit": upsert_dimension("produit", parts),
        "retailer": upsert_dimension("retailer", retailers),
    }
    feed = dirty_feed(spark, sf_dir) if dirty else sales_feed(spark, sf_dir)
    return Star(fact=load_fact(feed, dims, keep=FEED_KEYS), **dims)


def event_sales(events: DataFrame) -> DataFrame:
    """The `events` table (batch or stream) read as sales records with a dense sequence number."""
    value = F.col("value").try_cast(S.MONEY)
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("region"),
        F.col("user_id").cast("string").alias("retailer"),
        F.get_json_object("props", "$.k").cast(S.UNITS).alias("units_sold"),
        F.when(F.col("event_id") % 7 == 3, (-value).cast(S.MONEY)).otherwise(value).alias("total_sales"),
    )


def untyped_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as texts; some columns have a few values that ask for a wider type than all others."""
    orders = table(spark, sf_dir, "orders")
    key, text = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    return orders.select(
        text.alias("key"),
        F.when(key % 3 == 0, "NA").otherwise(text).alias("gaps"),
        F.when(key % 101 == 5, F.concat(text, F.lit(".25"))).otherwise(text).alias("widened"),
        F.when(key % 103 == 7, F.concat(text, F.lit("e2"))).otherwise(text).alias("floating"),
        F.when(key % 107 == 11, F.lit("n.v.")).otherwise(text).alias("mixed"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.lit(None).cast("string").alias("empty"),
        F.concat(F.lit('a "'), "o_orderstatus", F.lit('", b')).alias("quoted"),
    )
