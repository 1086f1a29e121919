"""Hand-worked scores and gate behaviour."""

from functools import reduce
from operator import add

import pytest
from pyspark.sql import functions as F

from salesflow.functions.exact import round_binary
from salesflow.operators import quality as Q

SCHEMA = "batch_no long, id long, region string, units_sold double, total_sales double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def batch(n, region="N", units=1.0, sales=2.0, batch_no=0, same=False):
    return [(batch_no, 0 if same else i, region, units, sales) for i in range(n)]


def scored(df):
    return Q.dq_log(Q.score_batches(df)).first()


def test_one_failed_rule_passes(spark):
    row = scored(frame(spark, batch(100, sales=None)))
    assert (float(row.dq_score), row.status) == (83.33, "PASSED")
    assert (row.passed_rows, row.failed_rows) == (83, 16)  # 99 of 100: both are cut off
    assert row.details["no_null_total_sales"] == 0.0
    assert row.details["positive_sales"] == 100.0  # a missing value is not a negative one


def test_two_failed_rules_block(spark):
    row = scored(frame(spark, batch(100, sales=None, region=None)))
    assert (float(row.dq_score), row.status) == (66.67, "BLOCKED")


def test_equal_rows(spark):
    row = scored(frame(spark, batch(100, same=True)))
    assert row.details["no_duplicate_rows"] == 1.0
    assert float(row.dq_score) == 83.5


def test_nan_is_missing(spark):
    row = scored(frame(spark, batch(50) + batch(50, sales=float("nan"))))
    assert row.details["no_null_total_sales"] == 50.0
    assert row.details["positive_sales"] == 100.0


def test_partial_batch_is_scored_like_any_other(spark):
    rows = batch(100) + batch(37, region=None, units=None, batch_no=1)
    log = Q.score_batches(frame(spark, rows))
    got = {r.batch_no: (r.total_rows, r.status) for r in log.collect()}
    assert got == {0: (100, "PASSED"), 1: (37, "BLOCKED")}


def test_missing_column_scores_zero(spark):
    row = scored(frame(spark, batch(100)).drop("units_sold"))
    assert row.details["no_null_units_sold"] == row.details["positive_units"] == 0.0
    assert (float(row.dq_score), row.status) == (66.67, "BLOCKED")


def test_unreadable_text_fails_the_sign_rule(spark):
    df = frame(spark, batch(9)).withColumn("total_sales", F.when(F.col("id") == 3, "n/a").otherwise("2.5"))
    row = scored(df)
    assert row.details["positive_sales"] == 0.0
    assert row.details["no_null_total_sales"] == 100.0


def test_dup_keys_narrow_the_duplicate_rule(spark):
    df = frame(spark, [(0, i // 2, "N", float(i), 1.0) for i in range(10)])
    full = Q.score_batches(df).first()
    keyed = Q.score_batches(df, dup_keys=["id"]).first()
    assert (full.no_duplicate_rows, keyed.no_duplicate_rows) == (100.0, 50.0)


def test_scores_match_a_plain_computation(spark):
    """Brute force over many random batches, Python's own rounding included."""
    import random

    random.seed(5)
    rows = []
    for b in range(60):
        for _ in range(random.randint(1, 130)):
            rows.append((
                b, random.randint(0, 40), random.choice(["N", "S", None]), random.choice([1.0, -1.0, None]),
                random.choice([2.0, 3.0, -1.0, None]),
            ))
    want = {}
    for b in range(60):
        mine = [r for r in rows if r[0] == b]
        n = len(mine)
        share = lambda ok: round(sum(map(ok, mine)) / n * 100, 2)
        scores = [
            share(lambda r: r[3] is not None), share(lambda r: r[4] is not None), share(lambda r: r[2] is not None),
            share(lambda r: (r[4] or 0) >= 0), share(lambda r: (r[3] or 0) >= 0),
            round((1 - (n - len(set(mine))) / n) * 100, 2),
        ]
        overall = round(reduce(add, scores) / 6, 2)  # added one by one; sum() would compensate
        want[b] = (n, *scores, overall, int(n * overall / 100), int(n * (1 - overall / 100)))
    scores = Q.score_batches(frame(spark, rows))
    log = Q.dq_log(scores).select("batch_no", "passed_rows", "failed_rows")
    got = {
        r.batch_no: (r.total_rows, *[r[c] for c in Q.RULES], r.dq_score, r.passed_rows, r.failed_rows)
        for r in scores.join(log, "batch_no").collect()
    }
    assert got == want


def test_rounding_equals_pythons(spark):
    values = [(100 * 5 + k / 100) / 6 for k in range(10001)] + [k / n * 100 for n in range(1, 131) for k in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", round_binary(F.col("v"), 2).alias("r"))
    assert all(r.r == round(r.v, 2) for r in df.collect())


def test_gate_splits_the_rows(spark):
    df = frame(spark, batch(10) + batch(10, units=None, region=None, batch_no=1) + batch(5, batch_no=None))
    passed, rejected = Q.gate(df, Q.score_batches(df))
    assert passed.count() == 15 and rejected.count() == 10
    assert passed.unionAll(rejected).exceptAll(df).count() == 0


def test_hot_batch(spark):
    """One batch that holds most rows, mostly copies of a single row, is scored whole."""
    hot = spark.range(30000).select(
        F.lit(7).cast("long").alias("batch_no"), F.when(F.col("id") < 20000, 0).otherwise(F.col("id")).alias("id"),
        F.lit("N").alias("region"), F.lit(1.0).alias("units_sold"), F.lit(2.0).alias("total_sales"),
    )
    row = Q.score_batches(hot.union(frame(spark, batch(100)))).where("batch_no = 7").first()
    assert row.total_rows == 30000
    assert row.no_duplicate_rows == round((1 - 19999 / 30000) * 100, 2)


# ── dataset checks ───────────────────────────────────────────────────────────
def checks(df):
    row = Q.dataset_score(Q.dataset_checks(Q.profile(df))).first()
    return row.dq_score, row.passed, {c.name: (c.passed, c.detail) for c in row.details}


def test_empty_dataset(spark):
    score, passed, found = checks(frame(spark, []))
    assert (score, passed) == (80, True)
    assert [n for n, (ok, _) in found.items() if not ok] == ["min_rows"]


def test_two_failed_checks_block(spark):
    rows = batch(20) + batch(20) + [(0, 99, "N", -1.0, -2.0)]
    score, passed, found = checks(frame(spark, rows))
    assert (score, passed) == (60, False)
    assert found["no_duplicates"] == (False, "20 doublons")
    assert found["positive_values"] == (
        False, "['units_sold: 1 valeurs négatives', 'total_sales: 1 valeurs négatives']"
    )


def test_sparse_column_and_empty_rows(spark):
    rows = [(i, i, "N", None, 1.0) for i in range(10)] + [(None,) * 5]
    score, _, found = checks(frame(spark, rows))
    assert score == 60
    assert found["null_rate_ok"] == (False, "Colonnes >30% null: {'units_sold': 100.0}")
    assert found["no_empty_rows"] == (False, "1 lignes vides")


@pytest.mark.parametrize(
    ("name", "guarded"),
    [("Total Sales", True), ("category", True), ("quantity", False), ("qty_sold", True), ("price", False)],
)
def test_guarded_names(spark, name, guarded):
    df = spark.range(1).withColumnRenamed("id", name)
    assert (name in Q.guarded_columns(df.schema)) == guarded
    assert Q.guarded_columns(df.withColumn(name, F.lit("x")).schema) == []
