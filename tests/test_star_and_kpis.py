"""Dimension upsert, fact load, KPIs and reports."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesflow.operators import clean as C
from salesflow.operators import kpis as K
from salesflow.operators import reports as R
from salesflow.operators import star as ST
from salesflow.plans import jobs
from salesflow.sources import sinks
from salesflow.sources import testtables as TT


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


@pytest.fixture(scope="module")
def star(spark, small):
    return TT.star(spark, small)


@pytest.fixture(scope="module")
def dirty(spark, small):
    return TT.star(spark, small, dirty=True)


def test_ids_are_stable_and_unique(spark):
    names = spark.range(5000).select(F.concat(F.lit("shop "), "id").alias("retailer_name"))
    first = ST.upsert_dimension("retailer", names.where("length(retailer_name) < 9"))
    second = ST.upsert_dimension("retailer", names.union(names), first)
    before = dict(first.select("retailer_name", "retailer_id").collect())
    after = dict(second.select("retailer_name", "retailer_id").collect())
    assert len(after) == 5000 == len(set(after.values())) == second.count()
    assert all(after[n] == i for n, i in before.items())
    assert min(i for n, i in after.items() if n not in before) > max(before.values())
    again = ST.upsert_dimension("retailer", names, second)
    assert dict(again.select("retailer_name", "retailer_id").collect()) == after


def test_product_falls_back_to_brand_and_null_names_are_unknown(spark):
    records = spark.createDataFrame(
        [(None, None, "Cola", None), ("N", "Zero", "Cola", "Shop"), (None, None, None, None)],
        "region string, product string, beverage_brand string, retailer string",
    )
    assert {tuple(r) for r in ST.members_of(records, "produit").collect()} == {
        ("Cola", "Cola"), ("Zero", "Cola"), ("Unknown", ""),
    }
    assert {r[0] for r in ST.members_of(records, "region").collect()} == {"Unknown", "N"}


def test_same_product_name_of_two_brands_is_two_members(spark, star):
    assert star.produit.count() == star.produit.select("product_name", "beverage_brand").distinct().count()
    assert star.produit.select("product_name").distinct().count() < star.produit.count()


def test_unread_lookups_leave_the_plan(star):
    plan = R.view_global_kpis(star.fact)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan


def test_star_join_keeps_facts_without_a_retailer(star):
    nobody = replace(star, retailer=star.retailer.limit(0))
    joined = ST.star_join(nobody)
    assert joined.count() == star.fact.count()
    assert joined.where("retailer is not null").count() == 0
    assert ST.star_join(replace(star, region=star.region.limit(0))).count() == 0


def test_monthly_kpis_equal_the_join_first_form(dirty):
    plain = K.kpi_monthly(C.clean_sales(ST.star_join(dirty), distinct=False))
    assert rows_of(jobs.monthly_kpis(dirty)) == rows_of(plain)


def test_kpi_sums_add_up(dirty):
    cleaned = C.clean_facts(dirty.fact)
    total = cleaned.agg(F.sum("total_sales"), F.count("*")).first()
    kpis = R.monthly_kpis(dirty, cleaned).agg(F.sum("ca_total"), F.sum("nb_transactions")).first()
    assert tuple(total) == tuple(kpis)


def test_null_keys_and_all_null_sums(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 5), "N", "A", None), (dt.date(2024, 1, 6), None, "A", Decimal(3)), (None, "N", "A", Decimal(3))],
        "date_vente date, region string, product string, total_sales decimal(14,2)",
    )
    for c in ("operating_profit", "units_sold", "price_per_unit", "operating_margin"):
        df = df.withColumn(c, F.lit(None).cast("decimal(10,4)"))
    row = K.kpi_monthly(df).collect()
    assert len(row) == 1
    assert (row[0].ca_total, row[0].panier_moyen, row[0].nb_transactions) == (0, None, 1)


def test_month_report_equals_the_view_form(star):
    assert rows_of(R.sales_by_month(star)) == rows_of(R.sales_by_month_from_view(R.view_region_month(star)))


def test_trend_equals_region_rollup(spark, small):
    rows = TT.sales_feed(spark, small).select(
        "region", F.date_format("date_vente", "yyyy-MM").alias("mois"), F.col("total_sales").alias("sales")
    )
    rolled = K.trend_from_regions(K.kpi_region_month(rows))
    assert rows_of(rolled) == rows_of(K.kpi_trend(rows).drop("avg_sales"))


def test_reports_over_an_empty_fact(star):
    empty = replace(star, fact=star.fact.limit(0))
    row = R.global_kpis(empty.fact).first()
    assert (row.total_transactions, row.ca_total, row.profit_total, row.marge_moyenne_pct) == (0, 0, 0, 0)
    assert R.view_global_kpis(empty.fact).first().ca_total is None
    assert R.top_products(empty).count() == 0


def test_written_star_gives_the_same_reports(spark, small, tmp_path):
    feed = TT.sales_feed(spark, small)
    stored = jobs.load_star(spark, feed, str(tmp_path))
    assert rows_of(R.sales_by_region(stored)) == rows_of(R.sales_by_region(TT.star(spark, small)))
    assert rows_of(ST.star_join(stored)) == rows_of(ST.star_join(TT.star(spark, small)))
    plan = stored.fact.where("mois = '1996-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(mois" in plan


def test_keyed_writes_replace_their_slice(spark, tmp_path):
    path = str(tmp_path / "log")
    for n in (3, 5, 5):
        sinks.write_keyed(spark.range(n), path, "run", n)
    assert spark.read.parquet(path).groupBy("run").count().orderBy("run").collect() == [(3, 3), (5, 5)]


def test_export_cleans_names(spark, tmp_path):
    sinks.export_table(spark.sql("select 1 as `Total Sales`, 2 as `x`"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).columns == ["total_sales", "x"]
