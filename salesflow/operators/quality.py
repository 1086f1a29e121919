"""Data-quality scores of record batches and of whole datasets.

A row is first reduced to its batch, a flag or two per rule, and a 128-bit digest of its
fields; only those are shuffled. Equal ones are merged into one row with a number of copies.
That merge pre-aggregates before its shuffle and spreads a batch over as many tasks as it has
distinct rows, so a batch may be of any size; every rule is then a plain weighted sum.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow import schema as S
from salesflow.functions.exact import percent, round_binary
from salesflow.functions.parsing import nan_to_null, quoted, to_number

COPIES = "_copies"
DIGEST = "_digest"


# ── batch rules ──────────────────────────────────────────────────────────────
# A rule turns the schema into flags of a row and the share of good rows as an aggregate of
# these flags and the copies, or into None where it cannot be applied.
Flags = dict[str, Column]
Rule = Callable[[T.StructType], tuple[Flags, Callable[[dict[str, Column]], Column]] | None]


def _good_rows(good: Column) -> Column:
    return F.sum(F.when(good, F.col(COPIES)).otherwise(0))


def not_null(column: str) -> Rule:
    def rule(schema: T.StructType):
        if column not in schema.names:
            return None
        return {"good": quoted(column).isNotNull()}, lambda flag: percent(_good_rows(flag["good"]), F.sum(COPIES))

    return rule


def not_negative(column: str) -> Rule:
    """Missing values count as good; a batch with unreadable text in the column scores 0."""

    def rule(schema: T.StructType):
        if column not in schema.names:
            return None
        value = quoted(column)
        text = isinstance(schema[column].dataType, T.StringType)
        number = to_number(value, T.DoubleType()) if text else value
        flags = {"good": F.coalesce(number >= 0, F.lit(True))}
        if text:
            flags["unreadable"] = value.isNotNull() & number.isNull()

        def score(flag: dict[str, Column]) -> Column:
            share = percent(_good_rows(flag["good"]), F.sum(COPIES))
            return F.when(F.max(flag["unreadable"]), 0.0).otherwise(share) if text else share

        return flags, score

    return rule


def no_duplicates() -> Rule:
    """Share of rows that are not copies of an earlier one; needs rows merged by all their fields."""

    def rule(schema: T.StructType):
        repeated = (F.sum(COPIES) - F.count("*")) / F.sum(COPIES)
        return {}, lambda flag: round_binary((1 - repeated) * 100, 2)

    return rule


# Names of the rules.
RULES: dict[str, Rule] = {
    "no_null_units_sold": not_null("units_sold"),
    "no_null_total_sales": not_null("total_sales"),
    "no_null_region": not_null("region"),
    "positive_sales": not_negative("total_sales"),
    "positive_units": not_negative("units_sold"),
    "no_duplicate_rows": no_duplicates(),
}


def digest(columns: list[str]) -> Column:
    """128 bits of the fields of a row; missing fields are told apart from their neighbours."""
    fields = [quoted(c) for c in columns] + [quoted(c).isNull() for c in columns]
    return F.struct(F.xxhash64(*fields).alias("a"), F.xxhash64(F.lit(1), *fields).alias("b"))


def score_batches(
    df: DataFrame,
    batch: list[str] | str = "batch_no",
    rules: dict[str, Rule] = RULES,
    dup_keys: list[str] | None = None,
    threshold: float = S.DQ_THRESHOLD,
    ignore: list[str] | None = None,
) -> DataFrame:
    """One row per batch: number of rows, the score of each rule, overall score and status.

    Rows are equal when all their fields are, but for those in `ignore`, such as the offset
    an event was delivered under; `dup_keys` narrows that to an event key.
    """
    batch = [batch] if isinstance(batch, str) else batch
    rows = nan_to_null(df)
    scores = _rule_scores(rows, batch, rules, [c for c in rows.columns if c not in (ignore or ()) or c in batch])
    if dup_keys:
        uniques = _rule_scores(
            rows.select(*batch, *dup_keys), batch, {"no_duplicate_rows": no_duplicates()}, [*batch, *dup_keys]
        )
        same = [scores[b].eqNullSafe(uniques[b]) for b in batch]
        narrowed = uniques["no_duplicate_rows"]
        scores = scores.join(uniques, same).select(
            *[scores[c] if c != "no_duplicate_rows" else narrowed for c in scores.columns]
        )
    total = sum((F.col(r) for r in rules), F.lit(0.0))
    overall = round_binary(total / len(rules), 2)
    status = F.when(F.col("dq_score") >= threshold, S.PASSED).otherwise(S.BLOCKED)
    return scores.withColumn("dq_score", overall).withColumn("status", status)


def _rule_scores(rows: DataFrame, batch: list[str], rules: dict[str, Rule], columns: list[str]) -> DataFrame:
    flags, measures = {}, []
    for i, (name, rule) in enumerate(rules.items()):
        found = rule(rows.schema)
        if found is None:
            measures.append(F.lit(0.0).alias(name))
            continue
        own, score = found
        flags |= {f"_flag_{i}_{k}": c for k, c in own.items()}
        measures.append(score({k: F.col(f"_flag_{i}_{k}") for k in own}).alias(name))
    narrow = rows.select(*batch, digest(columns).alias(DIGEST), *[c.alias(n) for n, c in flags.items()])
    merged = narrow.groupBy(*narrow.columns).agg(F.count("*").alias(COPIES))
    return merged.groupBy(*batch).agg(F.sum(COPIES).alias("total_rows"), *measures)


def dq_log(scores: DataFrame, batch: list[str] | str = "batch_no", source: str = "ventes",
           rules: dict[str, Rule] = RULES) -> DataFrame:
    """Quality-log rows. Passed and failed rows are truncated and need not add up to the total."""
    batch = [batch] if isinstance(batch, str) else batch
    overall, n = F.col("dq_score"), F.col("total_rows")
    names = F.array(*[F.lit(r) for r in rules])
    return scores.select(
        F.concat_ws("-", F.lit(source), *batch).alias("batch_id"),
        *batch,
        n,
        F.floor(n * overall / 100).cast("long").alias("passed_rows"),
        F.floor(n * (1 - overall / 100)).cast("long").alias("failed_rows"),
        overall.cast(S.SCORE).alias("dq_score"),
        "status",
        F.map_from_arrays(names, F.array(*[F.col(r) for r in rules])).alias("details"),
    )


def gate(df: DataFrame, log: DataFrame, batch: list[str] | str = "batch_no") -> tuple[DataFrame, DataFrame]:
    """Rows of batches that passed, and rows of blocked ones.

    Every batch has a status, so the passed rows are those not in a blocked batch; blocked
    batches are the few. With a stored log Catalyst knows their size and can broadcast them.
    """
    batch = [batch] if isinstance(batch, str) else batch
    blocked = log.where(F.col("status") == S.BLOCKED).select(*[F.col(b).alias(f"_blocked_{b}") for b in batch])
    same = [df[b].eqNullSafe(blocked[f"_blocked_{b}"]) for b in batch]
    return df.join(blocked, same, "left_anti"), df.join(blocked, same, "left_semi")


# ── dataset checks ───────────────────────────────────────────────────────────
# Thresholds of the checks.
MIN_ROWS = 10
MAX_NULL_PERCENT = 30


def guarded_columns(schema: T.StructType) -> list[str]:
    """Numeric columns whose name says they hold sales figures."""
    return [
        f.name
        for f in schema.fields
        if isinstance(f.dataType, T.NumericType) and any(p in f.name.lower() for p in S.SALES_NAME_PARTS)
    ]


def profile(df: DataFrame) -> DataFrame:
    """Everything the dataset checks need, in one row.

    Columns: rows, empty_rows, distinct_rows, nulls (map by column) and negatives (map by
    guarded column). Counts come from one pass without a shuffle of rows; the distinct rows are
    counted apart, from digests, and not at all where nobody reads them.
    """
    rows = nan_to_null(df)
    columns, guarded = rows.columns, guarded_columns(df.schema)
    empty = F.lit(True)
    for c in columns:
        empty = empty & quoted(c).isNull()

    def by_name(names: list[str], condition: Callable[[str], Column]) -> Column:
        keys = F.array(*[F.lit(c) for c in names]).cast("array<string>")
        return F.map_from_arrays(keys, F.array(*[F.count_if(condition(c)) for c in names]).cast("array<bigint>"))

    distinct = rows.select(digest(columns).alias(DIGEST)).distinct().agg(F.count("*").alias("n")).scalar()
    counted = rows.agg(
        F.count("*").alias("rows"),
        F.count_if(empty).alias("empty_rows"),
        by_name(columns, lambda c: quoted(c).isNull()).alias("nulls"),
        by_name(guarded, lambda c: quoted(c) < 0).alias("negatives"),
    )
    return counted.select("rows", "empty_rows", distinct.alias("distinct_rows"), "nulls", "negatives")


def null_rates(profiled: DataFrame) -> DataFrame:
    """Null percentage of each column, and whether it is too high."""
    rate = F.col("nulls") / F.nullif(F.col("rows"), F.lit(0)) * 100
    return profiled.select("rows", F.explode("nulls").alias("column_name", "nulls")).select(
        "column_name",
        round_binary(rate, 1).alias("null_rate"),
        F.coalesce(rate > MAX_NULL_PERCENT, F.lit(False)).alias("too_high"),
    )


def negative_columns(profiled: DataFrame) -> DataFrame:
    """Number of negative values of each guarded column."""
    return profiled.select(F.explode("negatives").alias("column_name", "negatives"))


def dataset_checks(profiled: DataFrame) -> DataFrame:
    """One row whose `checks` lists the five checks as (name, passed, detail)."""
    duplicates = F.col("rows") - F.col("distinct_rows")
    share = lambda n: n / F.nullif(F.col("rows"), F.lit(0)) * 100
    sparse = F.map_filter("nulls", lambda _, n: F.coalesce(share(n) > MAX_NULL_PERCENT, F.lit(False)))
    sparse_text = F.concat_ws(
        ", ",
        F.transform(
            F.map_entries(sparse),
            lambda e: F.concat(F.lit("'"), e["key"], F.lit("': "), round_binary(share(e["value"]), 1).cast("string")),
        ),
    )
    negative = F.map_filter("negatives", lambda _, n: n > 0)
    # Wording of the report details.
    negative_text = F.concat_ws(
        ", ",
        F.transform(
            F.map_entries(negative),
            lambda e: F.concat(F.lit("'"), e["key"], F.lit(": "), e["value"].cast("string"), F.lit(" valeurs négatives'")),
        ),
    )
    # Names of the checks and wording of their details.
    checks = [
        ("no_empty_rows", F.col("empty_rows") == 0, F.concat(F.col("empty_rows"), F.lit(" lignes vides"))),
        ("no_duplicates", duplicates == 0, F.concat(duplicates, F.lit(" doublons"))),
        ("min_rows", F.col("rows") >= MIN_ROWS, F.concat(F.col("rows"), F.lit(" lignes"))),
        (
            "null_rate_ok",
            F.size(sparse) == 0,
            F.when(F.size(sparse) == 0, "OK").otherwise(
                F.concat(F.lit("Colonnes >30% null: {"), sparse_text, F.lit("}"))
            ),
        ),
        (
            "positive_values",
            F.size(negative) == 0,
            F.when(F.size(negative) == 0, "OK").otherwise(F.concat(F.lit("["), negative_text, F.lit("]"))),
        ),
    ]
    return profiled.select(
        F.array(
            *[F.struct(F.lit(n).alias("name"), ok.alias("passed"), d.alias("detail")) for n, ok, d in checks]
        ).alias("checks")
    )


def dataset_score(checked: DataFrame, threshold: float = S.DQ_THRESHOLD) -> DataFrame:
    """Score out of 100, the verdict, and the checks behind them."""
    passed = F.size(F.filter("checks", lambda c: c["passed"]))
    score = round_binary(passed / F.size("checks") * 100, 0).cast("int")
    return checked.select(score.alias("dq_score"), (score >= threshold).alias("passed"), F.col("checks").alias("details"))
