"""Parsing, cleaning and exact quantiles."""

import math
import random
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from salesflow.functions import parsing as P
from salesflow.functions.exact import rounded_mean
from salesflow.functions.quantiles import exact_quantiles, histogram
from salesflow.operators import clean as C
from salesflow.operators import normalize as N
from salesflow.plans import jobs
from salesflow.sources.readers import read_csv, read_table


def one(spark, value, dtype, expr):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    ("text", "want"),
    [("2024-01-31", "2024-01-31"), ("1/31/2024", "2024-01-31"), ("04/05/2024", "2024-04-05"),
     ("31/01/2024", "2024-01-31"), ("n/a", None), (None, None), ("", None)],
)
def test_dates(spark, text, want):
    got = one(spark, text, "string", P.to_date)
    assert (str(got) if got else None) == want
    assert str(one(spark, text, "string", P.to_date_or)) == (want or "2023-01-01")


def test_typed_dates_pass_through(spark):
    df = spark.sql("select date'2024-02-29' d, timestamp'2024-02-29 10:00:00' t")
    row = df.select(P.to_date(F.col("d")).alias("d"), P.to_date(F.col("t")).alias("t")).first()
    assert str(row.d) == str(row.t) == "2024-02-29"


@pytest.mark.parametrize(
    ("value", "unit", "want"),
    [("31.5%", "percent", "0.3150"), ("31.5", "percent", "0.3150"), ("0.31", "percent", "0.0031"),
     ("0.31", "ratio", "0.3100"), ("n/a", "percent", None)],
)
def test_margins(spark, value, unit, want):
    got = one(spark, value, "string", lambda v: P.to_ratio(v, unit))
    assert got == (Decimal(want) if want else None)


def test_numbers(spark):
    assert one(spark, "12.50", "string", P.to_number) == Decimal("12.50")
    assert one(spark, "n/a", "string", P.to_number) is None
    assert one(spark, "9" * 20, "string", P.to_number) is None
    assert one(spark, float("nan"), "double", P.to_number) is None


def test_headers(spark):
    df = spark.createDataFrame([("a", "b", "c", "d")], [" Retailer ", "Date", "Invoice Date", "Extra Col"])
    assert N.normalize_headers(df).first().asDict() == {"retailer": "a", "invoice_date": "b", "extra col": "d"}


def test_roles():
    roles = N.detect_roles(["Zone", "Invoice Date", " Total Sales", "QTY", "beverage_brand", "sku"])
    assert roles == {
        "region": "Zone", "date": "Invoice Date", "sales": " Total Sales", "units": "QTY", "product": "beverage_brand",
    }
    with pytest.raises(ValueError, match="region"):
        N.detect_roles(["a"], ("region",))


def test_records_from_raw_text(spark):
    raw = spark.createDataFrame(
        [("Shop", "1/15/2024", "North", "Cola", None, "2", "10", "20", "5", "25%")],
        "`Retailer` string, `Invoice Date` string, `Region` string, `Beverage Brand` string, `Product` string, "
        "`Price per Unit` string, `Units Sold` string, `Total Sales` string, `Operating Profit` string, "
        "`Operating Margin` string",
    )
    row = N.fill_texts(N.to_records(N.normalize_headers(raw))).first()
    assert (str(row.date_vente), row.product, row.operating_margin) == ("2024-01-15", "Cola", Decimal("0.2500"))


@pytest.mark.parametrize(("total", "n", "want"), [("10.05", 2, "5.03"), ("-10.05", 2, "-5.03"), ("1.00", 3, "0.33")])
def test_rounded_mean(spark, total, n, want):
    df = spark.sql(f"select cast('{total}' as decimal(24,2)) t, {n}L n")
    assert df.select(rounded_mean(F.col("t"), F.col("n"), 2).alias("m")).first().m == Decimal(want)


def test_rounded_mean_of_nothing(spark):
    df = spark.sql("select cast(null as decimal(24,2)) t, 0L n")
    assert df.select(rounded_mean(F.col("t"), F.col("n"), 2).alias("m")).first().m is None


# ── quantiles and fences ─────────────────────────────────────────────────────
@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(10**13), 10**13), min_size=1, max_size=40))
def test_quantiles_equal_linear_interpolation(spark, cents):
    values = [Decimal(c) / 100 for c in cents] + [None]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(14,2)")
    hist = histogram(df, ["v"])
    got = exact_quantiles(hist, "v", [0.25, 0.5, 0.75])
    hist.release()
    want = np.quantile([float(c) / 100 for c in cents], [0.25, 0.5, 0.75])
    assert np.allclose(got, want, rtol=1e-12, atol=1e-6)


def test_quantiles_of_whole_numbers_and_hot_values(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 700, 5).otherwise(F.col("id") * 10**12).alias("v"))
    got = exact_quantiles(histogram(df, ["v"]), "v", [0.25, 0.75])
    want = np.quantile([5] * 700 + [i * 10**12 for i in range(700, 1000)], [0.25, 0.75])
    assert np.allclose(got, want, rtol=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "v decimal(14,2)")
    assert exact_quantiles(histogram(df, ["v"]), "v", [0.5]) is None


@pytest.mark.parametrize("seed", range(4))
def test_quantiles_of_doubles(spark, seed):
    rnd = np.random.default_rng(seed)
    values = [rnd.normal(size=500), np.exp(rnd.normal(size=300) * 50), np.full(200, 0.1), rnd.choice([-1e300, 1e300, 5e-324, 0.0], 99)][seed]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
    got = exact_quantiles(histogram(df, ["v"]), "v", [0.25, 0.5, 0.9])
    order = np.sort(values)
    for p, g in zip((0.25, 0.5, 0.9), got, strict=True):
        place = p * (len(order) - 1)
        low, high = order[int(np.floor(place))], order[int(np.ceil(place))]
        assert g == low + (high - low) * (place - np.floor(place))


def test_too_wide_decimals_are_refused(spark):
    with pytest.raises(TypeError):
        histogram(spark.sql("select cast(1 as decimal(30,2)) v"), ["v"])


def test_free_dates_are_read(spark):
    texts = ["2024/01/05", "Jan 5, 2024", "January 5, 2024", "5 Jan 2024", "05.01.2024", "2024-01-05T10:00:00", "soon", None]
    rows = spark.createDataFrame([(t,) for t in texts], "v string").select(P.to_date_or(F.col("v")).alias("d")).collect()
    assert [str(r.d) for r in rows] == ["2024-01-05"] * 6 + ["2023-01-01"] * 2


def test_csv_by_header_and_null_texts(spark, tmp_path):
    (tmp_path / "a.csv").write_text('units,name\n1,"He said ""hi"", ok"\nNA,null\nx,N/A\n')
    rows = read_csv(spark, str(tmp_path / "a.csv"), StructType([StructField("name", StringType()), StructField("units", LongType())]))
    assert [tuple(r) for r in rows.collect()] == [('He said "hi", ok', 1), (None, None), (None, None)]
    with pytest.raises(ValueError, match="other"):
        read_csv(spark, str(tmp_path / "a.csv"), StructType([StructField("other", StringType())]))


def pandas_clean(pdf):
    pdf = pdf.dropna(subset=["units_sold", "total_sales", "region"]).drop_duplicates()
    pdf = pdf[(pdf.units_sold >= 0) & (pdf.total_sales >= 0)]
    for c in ["units_sold", "total_sales"]:
        q1, q3 = pdf[c].quantile(0.25), pdf[c].quantile(0.75)
        pdf = pdf[pdf[c].between(q1 - 3 * (q3 - q1), q3 + 3 * (q3 - q1))]
    return pdf


def test_cleaning_equals_pandas(spark):
    random.seed(3)
    rows = []
    for i in range(800):
        units = random.choice([None, -1, random.randint(1, 30), random.randint(1, 30), 5000])
        sales = random.choice([None, -5, random.randint(100, 9000), random.randint(100, 9000), 10**7])
        rows.append((i // 2, random.choice(["N", "S", None]), units, sales))
    rows += rows[:50]
    schema = "id long, region string, units_sold decimal(12,2), total_sales decimal(14,2)"
    dec = [(i, r, None if u is None else Decimal(u), None if s is None else Decimal(s)) for i, r, u, s in rows]
    got = C.clean_sales(spark.createDataFrame(dec, schema)).toPandas()
    want = pandas_clean(pd.DataFrame(rows, columns=["id", "region", "units_sold", "total_sales"]))
    key = lambda f: sorted((r.id, r.region, float(r.units_sold), float(r.total_sales)) for r in f.itertuples())
    assert len(want) > 100 and key(got) == key(want)


def test_nan_rows_are_dropped(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (-1.0,)], "v double")
    assert C.drop_incomplete(df, ["v"]).count() == 2
    assert [r.v for r in C.non_negative(df, ["v"]).collect()] == [1.0]


def test_sketched_fences(spark):
    df = spark.range(1000).select((F.col("id") % 100).cast("double").alias("v"), F.col("id"))
    far = df.union(spark.sql("select 1e6, 5000L"))
    assert C.iqr_filter_approx(far, "v").count() == 1000
    assert C.iqr_filter_approx(df.limit(0), "v").count() == 0


def test_empty_input_stays_empty(spark):
    df = spark.createDataFrame([], "region string, units_sold decimal(12,2), total_sales decimal(14,2)")
    assert C.clean_sales(df).count() == 0


def test_file_job_writes_three_tables(spark, tmp_path):
    rows = [("N", "2024-01-05", float(i), "2") for i in range(20)] + [("N", "1/7/2024", 1e9, "2"), ("S", "bad", 3.0, "1")]
    df = spark.createDataFrame(rows, "`Region` string, `Invoice Date` string, `Total Sales` double, `Units Sold` string")
    jobs.run_file_job(df, str(tmp_path))
    clean = read_table(spark, f"{tmp_path}/fait_ventes_clean")
    assert clean.columns == ["region", "invoice_date", "total_sales", "units_sold"] and clean.count() == 21
    region = {(r.region, r.mois): r.count_transactions for r in read_table(spark, f"{tmp_path}/kpi_ventes_region").collect()}
    assert region == {("N", "2024-01"): 20, ("S", None): 1}
    trend = read_table(spark, f"{tmp_path}/kpi_tendance_temporelle")
    assert trend.count() == 2 and "computed_at" in trend.columns


def settled(df, column, probs, monkeypatch):
    """Quantiles of a column and the number of times rows came to the driver on the way."""
    from pyspark.sql.classic.dataframe import DataFrame

    hist, calls, plain = histogram(df, [column]), [], DataFrame.collect
    with monkeypatch.context() as patched:
        patched.setattr(DataFrame, "collect", lambda self: calls.append(1) or plain(self))
        found = exact_quantiles(hist, column, probs)
    hist.release()
    return found, len(calls)


PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("kind", ["decades", "ties", "close", "signs", "subnormal", "one"])
def test_quantiles_of_any_doubles_take_few_rounds(spark, monkeypatch, kind):
    rnd = random.Random(3)
    values = {
        "decades": [rnd.choice([-1, 1]) * 10.0 ** rnd.uniform(-300, 300) for _ in range(3000)],
        "ties": [float(rnd.choice([1, 1, 1, 2, 1e300, -1e-300])) for _ in range(2000)],
        "close": [1.0 + rnd.randrange(5000) * 2.0**-52 for _ in range(3000)],
        "signs": [rnd.uniform(-1, 1) * 1.7e308 for _ in range(1000)] + [0.0, -0.0],
        "subnormal": [rnd.randrange(-50, 50) * 5e-324 for _ in range(500)],
        "one": [3.5],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    found, rounds = settled(df, "v", PROBS, monkeypatch)
    assert found == pytest.approx(list(np.quantile(np.array(values), PROBS)), rel=1e-15, abs=0) if kind != "signs" else True
    ordered = sorted(values)
    assert found[0] == ordered[0] and found[-1] == ordered[-1] and rounds <= 5
    assert all(ordered[math.floor(p * (len(values) - 1))] <= f <= ordered[math.ceil(p * (len(values) - 1))] for p, f in zip(PROBS, found, strict=True))


def test_quantiles_without_values(spark, monkeypatch):
    df = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    assert settled(df, "v", PROBS, monkeypatch)[0] is None


def test_cleaning_does_not_multiply_expressions(spark):
    """What cleans a text column stands in the plan a few times, as each filter asks for it, and not once more per layer."""
    texts = spark.createDataFrame([("1.5",), ("NaN",), ("x",), ("-1",), (None,)], "v string")
    rows = P.nan_to_null(N.cast_numbers(texts, ["v"], jobs.S.AMOUNT))
    rows = C.dedupe(C.non_negative(C.drop_incomplete(rows, ["v"]), ["v"]))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast") <= 4
    assert [r.v for r in rows.collect()] == [1.5]
