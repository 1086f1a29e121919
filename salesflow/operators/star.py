"""Star schema: dimension upsert, fact load and the star join.

Joins carry no broadcast hint: Catalyst broadcasts a dimension whose size it knows to be
below the session's threshold and shuffles otherwise, where adaptive execution splits the
partitions of hot keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow import schema as S
from salesflow.functions.parsing import month_key
from salesflow.operators.normalize import fill_texts
from salesflow.session import sized
from salesflow.sources.versions import VersionedTable

# Dimension -> natural key, and the columns added to a new member.
NATURAL_KEYS = {
    "region": ["region_name"],
    "produit": ["product_name", "beverage_brand"],
    "retailer": ["retailer_name"],
}
MEMBER_DEFAULTS = {
    "region": {"country": S.DEFAULT_COUNTRY},
    "produit": {"category": None},
    "retailer": {"retailer_type": None},
}
# Record columns that hold the natural key.
RECORD_KEYS = {
    "region": ["region"],
    "produit": ["product", "beverage_brand"],
    "retailer": ["retailer"],
}
ID_BUCKETS = 4096
FACT_MEASURES = ["units_sold", "total_sales", "price_per_unit", "operating_profit", "operating_margin"]


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    region: DataFrame
    produit: DataFrame
    retailer: DataFrame


def id_bucket(columns: list[str]) -> Column:
    """Bucket of a natural key, 0 to 4095: the first three hex digits of its MD5."""
    digest = F.md5(F.concat_ws("|", *columns).cast("binary"))
    return F.conv(F.substring(digest, 1, 3), 16, 10).cast("long")


def new_members(dimension: str, incoming: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Members of `incoming` not yet in `existing`, with ids above every existing one.

    Ids are ranked inside 4096 hash buckets and interleaved, so no task ever sees all new
    names; like a sequence they are unique and may leave gaps.
    """
    keys, id_column = NATURAL_KEYS[dimension], f"{dimension}_id"
    names = incoming.select(*keys).distinct()
    base = F.lit(0).cast("long")
    if existing is not None:
        names = names.join(existing.select(*keys), keys, "left_anti")
        base = existing.select(F.coalesce(F.max(id_column), F.lit(0)).alias("base")).scalar()
    ranked = names.withColumn("_bucket", id_bucket(keys)).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_bucket").orderBy(*keys))
    )
    extra = {c: F.lit(v).cast("string") for c, v in MEMBER_DEFAULTS[dimension].items()}
    return ranked.select(
        (base + (F.col("_rank") - 1) * ID_BUCKETS + F.col("_bucket") + 1).alias(id_column),
        *keys,
        *[e.alias(c) for c, e in extra.items()],
    )


def upsert_dimension(dimension: str, incoming: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """The dimension after adding unseen members; known members keep their ids."""
    added = new_members(dimension, incoming, existing)
    return added if existing is None else existing.select(*added.columns).unionByName(added)


def upsert_stored(dimension: str, incoming: DataFrame, table: VersionedTable) -> DataFrame:
    """Add unseen members to a stored dimension and return it.

    Several loaders may do so at once: the ids are those above the version the new rows are added to, and a loader that
    finds another one has been first looks for unseen members again.
    """
    names = sized(incoming.select(*NATURAL_KEYS[dimension]).distinct())
    table.add(lambda existing: new_members(dimension, names, existing))
    names.unpersist()
    return table.read()


def members_of(records: DataFrame, dimension: str) -> DataFrame:
    """Natural keys of a dimension as the records name them, defaults filled in."""
    named = zip(RECORD_KEYS[dimension], NATURAL_KEYS[dimension])
    return fill_texts(records).select(*[F.col(c).alias(n) for c, n in named])


def load_fact(records: DataFrame, dims: dict[str, DataFrame], keep: list[str] | None = None) -> DataFrame:
    """Fact rows with dimension ids looked up by name, plus the month they are stored under.

    Lookups are left joins on unique keys, so Catalyst drops those whose id is not read.
    """
    rows = fill_texts(records)
    for dimension, members in dims.items():
        keys = NATURAL_KEYS[dimension]
        lookup = members.select(f"{dimension}_id", *[F.col(k).alias(f"_{k}") for k in keys])
        match = [rows[r] == lookup[f"_{k}"] for r, k in zip(RECORD_KEYS[dimension], keys)]
        rows = rows.join(lookup, match, "left").drop(*[f"_{k}" for k in keys])
    return rows.select(
        *(keep or []),
        "date_vente",
        *[f"{d}_id" for d in dims],
        *FACT_MEASURES,
        F.lit(100).alias("dq_score"),
        month_key(F.col("date_vente")).alias("mois"),
    )


def star_join(star: Star, keep: list[str] | None = None) -> DataFrame:
    """Facts with their names: region and product must exist, the retailer may be missing."""
    return (
        star.fact.join(star.region, "region_id")
        .join(star.produit, "produit_id")
        .join(star.retailer, "retailer_id", "left")
        .select(
            *(keep or []),
            "date_vente",
            *FACT_MEASURES,
            F.col("region_name").alias("region"),
            F.col("product_name").alias("product"),
            F.col("beverage_brand").alias("brand"),
            F.col("retailer_name").alias("retailer"),
        )
    )
