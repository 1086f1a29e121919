"""Registered queries: every operator run over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow import schema as S
from salesflow.functions import parsing as P
from salesflow.operators import clean as C
from salesflow.operators import forecast as FC
from salesflow.operators import kept as KV
from salesflow.operators import kpis as K
from salesflow.operators import normalize as N
from salesflow.operators import quality as Q
from salesflow.operators import reports as R
from salesflow.operators import segments as SEG
from salesflow.operators import star as ST
from salesflow.operators.split import chronological_split, eligible_groups
from salesflow.plans import jobs
from salesflow.session import checkpointed, new_dir, written
from salesflow.sources import readers, sinks
from salesflow.sources import testtables as TT
from salesflow.sources.inference import merged_profiles, type_profile
from salesflow.streaming import events as EV
from salesflow.streaming.gate import StreamGate, numbered

Query = Callable[[SparkSession, str], DataFrame]
KEYS = TT.FEED_KEYS
TIES = [*KEYS, "units_sold", "total_sales"]
#: Events to a file of a topic.
FILE_ROWS = 2_000_000
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines show the same type."""
    return df.select(
        *[
            P.quoted(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else P.quoted(f.name)
            for f in df.schema.fields
        ]
    )


# ── sources and sinks ────────────────────────────────────────────────────────
@query
def csv_scan(spark, sf_dir):
    feed = TT.sales_feed(spark, sf_dir)
    path = new_dir(spark, "feed-csv")
    feed.write.option("header", True).csv(path)
    return comparable(readers.read_csv(spark, path, feed.schema))


@query
def csv_quoted(spark, sf_dir):
    """Names with quotes, commas and line breaks, in a file whose columns have another order."""
    feed = TT.sales_feed(spark, sf_dir).select(*KEYS, "total_sales", "retailer")
    odd = F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit('The "'), "retailer", F.lit('", Ltd')))
    named = feed.withColumn("retailer", F.coalesce(odd, F.concat("retailer", F.lit("\nbranch "), F.col("l_linenumber"))))
    path = new_dir(spark, "quoted-csv")
    named.select(*reversed(named.columns)).write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    return comparable(readers.read_csv(spark, path, named.schema, multiline=True))


@query
def csv_inferred(spark, sf_dir):
    """A file whose columns turn out late to be wider than they looked, read without a schema."""
    path = new_dir(spark, "untyped-csv")
    TT.untyped_orders(spark, sf_dir).write.option("header", True).option("escape", '"').csv(path)
    return comparable(readers.read_csv(spark, path, infer=True))


@query
def csv_type_profile(spark, sf_dir):
    """What the types are decided by, merged from the profiles of two files."""
    rows = TT.untyped_orders(spark, sf_dir)
    profiles = []
    for odd in (0, 1):
        path = new_dir(spark, "untyped-csv")
        rows.where(F.col("key").cast("long") % 2 == odd).write.option("header", True).option("escape", '"').csv(path)
        profiles.append(type_profile(readers.read_csv(spark, path)))
    return merged_profiles(profiles[0].unionByName(profiles[1]))


@query
def header_normalize(spark, sf_dir):
    return N.normalize_headers(TT.text_feed(spark, sf_dir))


@query
def role_detect(spark, sf_dir):
    return N.by_role(TT.text_feed(spark, sf_dir), ("region", "date", "sales", "units"))


@query
def event_publish(spark, sf_dir):
    feed = TT.sales_feed(spark, sf_dir)
    return EV.to_events(feed, "run-1", F.to_timestamp(F.lit("2024-01-01 00:00:00")).cast("timestamp_ntz"))


@query
def event_ingest(spark, sf_dir):
    feed = TT.sales_feed(spark, sf_dir)
    root = new_dir(spark, "ingest")
    stamp = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    EV.publish_files(EV.to_events(feed, "run-1", stamp), f"{root}/topic")
    stream = EV.decode(EV.stream_files(spark, f"{root}/topic"), feed.schema)
    EV.run_to_table(stream, f"{root}/table", f"{root}/checkpoint")
    return comparable(spark.read.parquet(f"{root}/table").drop("event_time"))


@query
def clean_export(spark, sf_dir):
    path = new_dir(spark, "export")
    sinks.export_table(jobs.file_tables(TT.text_feed(spark, sf_dir), exact=True).clean, path)
    return comparable(readers.read_table(spark, path))


@query
def file_export_wide(spark, sf_dir):
    """Sales of three decimals, and some beyond any money column, kept as they are."""
    feed = TT.wide_feed(spark, sf_dir)
    path = new_dir(spark, "export-wide")
    sinks.export_table(jobs.file_tables(feed, exact=True).clean, path)
    return readers.read_table(spark, path).select(*KEYS, "units_sold", "total_sales")


@query
def file_region_wide(spark, sf_dir):
    return comparable(jobs.file_tables(TT.wide_feed(spark, sf_dir), exact=True).region)


@query
def fact_load(spark, sf_dir):
    return comparable(TT.star(spark, sf_dir, dirty=True).fact)


@query
def dq_log(spark, sf_dir):
    path = new_dir(spark, "dq_log")
    log = Q.dq_log(Q.score_batches(TT.dirty_feed(spark, sf_dir)))
    sinks.write_keyed(log, path, "run", 1)
    stored = readers.read_table(spark, path).drop("run")
    rest = [c for c in stored.columns if c != "details"]
    return comparable(stored.select(*rest, F.explode("details").alias("rule", "score")))


# ── projections and filters ──────────────────────────────────────────────────
def _normalised(spark, sf_dir):
    return N.normalize_headers(TT.text_feed(spark, sf_dir))


@query
def numeric_cast(spark, sf_dir):
    rows = N.cast_numbers(_normalised(spark, sf_dir), ["units_sold", "total_sales"])
    return comparable(rows.select(*KEYS, "units_sold", "total_sales"))


@query
def numeric_cast_wide(spark, sf_dir):
    rows = N.cast_numbers(N.normalize_headers(TT.wide_feed(spark, sf_dir)), ["units_sold", "total_sales"])
    return rows.select(*KEYS, "units_sold", "total_sales")


@query
def percent_parse(spark, sf_dir):
    ratio = P.to_ratio(F.col("operating_margin")).alias("operating_margin")
    return comparable(_normalised(spark, sf_dir).select(*KEYS, ratio))


@query
def text_defaults(spark, sf_dir):
    rows = N.fill_texts(_normalised(spark, sf_dir))
    return rows.select(*KEYS, "region", "product", "beverage_brand", "retailer")


@query
def date_parse_fallback(spark, sf_dir):
    day = P.to_date_or(F.col("invoice_date")).alias("date_vente")
    return _normalised(spark, sf_dir).select(*KEYS, day)


@query
def date_parse_multi(spark, sf_dir):
    rows = N.add_month(_normalised(spark, sf_dir), "invoice_date")
    return rows.select(*KEYS, F.col("_date_parsed").alias("date_parsed"), "mois")


@query
def drop_incomplete(spark, sf_dir):
    return comparable(C.drop_incomplete(TT.dirty_feed(spark, sf_dir), ["units_sold", "total_sales", "region"]))


@query
def non_negative(spark, sf_dir):
    return comparable(C.non_negative(TT.dirty_feed(spark, sf_dir), ["units_sold", "total_sales"]))


@query
def dedupe(spark, sf_dir):
    return comparable(C.dedupe(TT.dirty_feed(spark, sf_dir)))


@query
def iqr_exact(spark, sf_dir):
    return comparable(C.iqr_filter(TT.dirty_feed(spark, sf_dir), ["units_sold", "total_sales"], 3.0))


@query
def iqr_exact_15(spark, sf_dir):
    return comparable(C.iqr_filter(TT.dirty_feed(spark, sf_dir), ["total_sales"], 1.5))


@query
def iqr_approx(spark, sf_dir):
    return comparable(C.iqr_filter_approx(TT.dirty_feed(spark, sf_dir), "total_sales"))


@query
def calendar_features(spark, sf_dir):
    rows = N.calendar_features(TT.sales_feed(spark, sf_dir))
    return rows.select(*KEYS, "date_vente", "month_num", "year_num", "day_of_week")


@query
def forecast_eligible(spark, sf_dir):
    return eligible_groups(TT.sales_feed(spark, sf_dir), "retailer", min_rows=30)


# ── star schema ──────────────────────────────────────────────────────────────
@query
def dim_upsert(spark, sf_dir):
    parts = TT.table(spark, sf_dir, "part").select(
        F.col("p_name").alias("product_name"), F.col("p_brand").alias("beverage_brand"), "p_size"
    )
    existing = ST.upsert_dimension("produit", parts.where("p_size < 25"))
    return ST.upsert_dimension("produit", parts, existing)


@query
def star_join(spark, sf_dir):
    return comparable(ST.star_join(TT.star(spark, sf_dir), KEYS))


@query
def star_join_left(spark, sf_dir):
    star = TT.star(spark, sf_dir)
    known = star.retailer.where(~F.col("retailer_name").endswith("7"))
    return comparable(ST.star_join(replace(star, retailer=known), KEYS))


# ── KPIs, views and reports ──────────────────────────────────────────────────
@query
def kpi_monthly(spark, sf_dir):
    return comparable(K.kpi_monthly(TT.dirty_feed(spark, sf_dir)))


def _file_rows(spark, sf_dir):
    rows = N.by_role(TT.text_feed(spark, sf_dir))
    return N.add_month(N.cast_numbers(rows, ["sales", "units"], T.DecimalType(38, 6)), "date")


@query
def kpi_region_month(spark, sf_dir):
    return comparable(K.kpi_region_month(_file_rows(spark, sf_dir)))


@query
def kpi_trend(spark, sf_dir):
    return comparable(K.kpi_trend(_file_rows(spark, sf_dir)))


@query
def view_region_month(spark, sf_dir):
    return comparable(R.view_region_month(TT.star(spark, sf_dir)))


def _kept_sums(spark, sf_dir, dirty=False):
    """Sums of the facts in five slices, one of which was loaded wrongly before and taken back.

    What is summed of the facts is stored once, by slice, so that a slice reads its own rows only.
    """
    star = TT.star(spark, sf_dir, dirty=dirty)
    part = F.col("_slice")
    summed = star.fact.select(*KV.DAY_KEYS, *KV.MEASURES, F.pmod(F.col("o_orderkey"), F.lit(5)).alias("_slice"))
    facts = written(summed, "facts", ["_slice"])
    star = replace(star, fact=facts)
    wrong = star.fact.where(part == 2).withColumns({"total_sales": F.col("total_sales") + 1, "date_vente": F.date_add("date_vente", 4000)})
    slices = [KV.slice_sums(wrong), *[KV.slice_sums(star.fact.where(part == i)) for i in range(5)], KV.slice_sums(wrong, -1)]
    path = new_dir(spark, "sums")
    for i, rows in enumerate(slices):
        sinks.write_keyed(rows, path, "mb", i)
    return KV.merged_sums(spark.read.parquet(path)), star


@query
def kept_region_month(spark, sf_dir):
    return comparable(KV.kept_region_month(*_kept_sums(spark, sf_dir)))


@query
def kept_global_kpis(spark, sf_dir):
    return comparable(KV.kept_global_kpis(_kept_sums(spark, sf_dir, dirty=True)[0]))


@query
def kept_sales_by_month(spark, sf_dir):
    return comparable(KV.kept_sales_by_month(*_kept_sums(spark, sf_dir)))


@query
def view_global_kpis(spark, sf_dir):
    return comparable(R.view_global_kpis(TT.star(spark, sf_dir, dirty=True).fact))


@query
def report_global_kpis(spark, sf_dir):
    return comparable(R.global_kpis(TT.star(spark, sf_dir).fact))


@query
def report_sales_by_region(spark, sf_dir):
    return comparable(R.sales_by_region(TT.star(spark, sf_dir)))


@query
def report_monthly_by_region(spark, sf_dir):
    return comparable(R.monthly_by_region(TT.star(spark, sf_dir)))


@query
def report_top_products(spark, sf_dir):
    return comparable(R.top_products(TT.star(spark, sf_dir)))


@query
def report_margin_by_region(spark, sf_dir):
    return comparable(R.margin_by_region(TT.star(spark, sf_dir)))


@query
def report_sales_by_month(spark, sf_dir):
    return comparable(R.sales_by_month(TT.star(spark, sf_dir)))


@query
def report_dq_history(spark, sf_dir):
    log = Q.dq_log(Q.score_batches(TT.dirty_feed(spark, sf_dir)))
    return comparable(R.dq_history(log, [F.desc("batch_no")]))


@query
def distinct_regions(spark, sf_dir):
    return K.distinct_regions(TT.dirty_feed(spark, sf_dir))


@query
def retailer_features(spark, sf_dir):
    return K.retailer_features(TT.sales_feed(spark, sf_dir))


# ── data quality ─────────────────────────────────────────────────────────────
@query
def dq_rules(spark, sf_dir):
    return Q.score_batches(TT.dirty_feed(spark, sf_dir)).select("batch_no", "total_rows", *Q.RULES)


@query
def dq_score(spark, sf_dir):
    scores = Q.score_batches(TT.dirty_feed(spark, sf_dir))
    return scores.select("batch_no", "total_rows", "dq_score", "status")


@query
def dq_gate(spark, sf_dir):
    feed = TT.dirty_feed(spark, sf_dir)
    return comparable(Q.gate(feed, Q.score_batches(feed))[0])


@query
def dq_rejects(spark, sf_dir):
    feed = TT.dirty_feed(spark, sf_dir)
    return comparable(Q.gate(feed, Q.score_batches(feed))[1])


@query
def dq_dataset_checks(spark, sf_dir):
    checks = Q.dataset_checks(Q.profile(TT.dirty_feed(spark, sf_dir)))
    return checks.select(F.inline("checks"))


@query
def dq_null_rates(spark, sf_dir):
    return Q.null_rates(Q.profile(TT.dirty_feed(spark, sf_dir)))


@query
def dq_negative_columns(spark, sf_dir):
    return Q.negative_columns(Q.profile(TT.dirty_feed(spark, sf_dir)))


@query
def dq_dataset_score(spark, sf_dir):
    scored = Q.dataset_score(Q.dataset_checks(Q.profile(TT.dirty_feed(spark, sf_dir))))
    failed = F.filter("details", lambda c: ~c["passed"])
    return scored.select("dq_score", "passed", F.concat_ws(", ", failed["name"]).alias("failed_checks"))


# ── streaming ────────────────────────────────────────────────────────────────
def _in_parts(df, path, place, parts):
    """Write a topic part by part, so that a file stream takes the parts in this order.

    A file is a micro-batch, so a part is as many files as its rows ask for, however many splits the table is read in.
    """
    for k in range(parts):
        part = df.where(place == k)
        part.repartition(1 + part.count() // FILE_ROWS).write.mode("append").parquet(path)


def _run_gate(spark, sf_dir):
    """The gate over five parts that cut quality batches and come in a shuffled order, a file at a time."""
    root = new_dir(spark, "gate")
    events = TT.table(spark, sf_dir, "events")
    place = F.pmod(F.floor((F.col("event_id") + 37) / 230) * 3, F.lit(5))
    _in_parts(events, f"{root}/topic", place, 5)
    topic = EV.stream_table(spark, f"{root}/topic", "*.parquet", events.schema, files_per_trigger=1)
    stream = numbered(TT.event_sales(topic))
    gate = StreamGate(spark, f"{root}/out", stream.schema)
    gate.run(stream)
    return gate


@query
def stream_gate(spark, sf_dir):
    return comparable(_run_gate(spark, sf_dir).table("accepted").drop("event_time"))


@query
def stream_scores(spark, sf_dir):
    log = _run_gate(spark, sf_dir).table("dq_log")
    return comparable(log.drop("details", "checked_at"))


@query
def dq_event_identity(spark, sf_dir):
    """Equal sales are no duplicates of each other; an event delivered again, under a new offset, is."""
    events = TT.table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("region"), F.lit(1).cast("double").alias("total_sales"),
        F.lit(2).cast("double").alias("units_sold"), F.call_function("div", F.col("event_id"), F.lit(S.BATCH_SIZE)).alias("batch_no"))
    offset = F.col("event_id").alias("offset")
    again = events.where("event_id % 450 = 7").select("*", (F.col("event_id") + 10**12).alias("offset"))
    scores = Q.score_batches(events.select("*", offset).unionByName(again), ignore=["offset"])
    return scores.select("batch_no", "total_rows", "no_duplicate_rows")


@query
def stream_dedupe(spark, sf_dir):
    root = new_dir(spark, "dedupe")
    events = TT.table(spark, sf_dir, "events")
    _in_parts(events, f"{root}/topic", F.pmod(F.xxhash64("event_id"), F.lit(4)), 4)
    _in_parts(events.where(F.col("event_id") % 50 == 7), f"{root}/topic", F.lit(0), 1)  # delivered again
    stream = TT.event_sales(EV.stream_table(spark, f"{root}/topic", "*.parquet", events.schema, files_per_trigger=1))
    EV.run_deduplicated(stream, f"{root}/table", f"{root}/checkpoint", ["seq"])
    return comparable(EV.read_deduplicated(spark, f"{root}/table", stream.schema).drop("event_time"))


# ── machine learning ─────────────────────────────────────────────────────────
@query
def train_test_split(spark, sf_dir):
    feed = TT.sales_feed(spark, sf_dir).select("region", "date_vente", *TIES)
    return comparable(chronological_split(feed, TIES))


@query
def retailer_features_scaled(spark, sf_dir):
    scaled = SEG.scaled_features(K.retailer_features(TT.sales_feed(spark, sf_dir)))
    return scaled.select("retailer", *[F.round(c, 6).alias(c) for c in SEG.FEATURES])


def _segments(spark, sf_dir):
    return SEG.segment_retailers(K.retailer_features(TT.sales_feed(spark, sf_dir)))


@query
def segments(spark, sf_dir):
    return _segments(spark, sf_dir)


@query
def segments_report(spark, sf_dir):
    path = new_dir(spark, "segments")
    sinks.replace_table(_segments(spark, sf_dir).withColumn("_id", F.uuid()), path)
    return SEG.segment_report(readers.read_table(spark, path))


@query
def segment_summary(spark, sf_dir):
    return SEG.segment_summary(_segments(spark, sf_dir))


@query
def segments_nearest(spark, sf_dir):
    """Of every retailer whether its segment is the nearest one, and of the segments whether sales fall from one to the next."""
    found = _segments(spark, sf_dir).transform(checkpointed)
    mean = found.groupBy("segment").agg(F.avg("ca_total").alias("m"), F.min("segment_label").alias("label"))
    falling = mean.agg(F.sort_array(F.collect_list(F.struct("segment", "m", "label"))).alias("all")).select(F.struct(
            ((F.col("all.m")[0] > F.col("all.m")[1]) & (F.col("all.m")[1] > F.col("all.m")[2])).alias("falling"),
            F.col("all.label").alias("labels"))).scalar()
    return SEG.nearest_segments(found).select(
        "retailer", (F.col("segment") == F.col("nearest")).alias("is_nearest"), falling["falling"].alias("falling"),
        F.concat_ws(",", falling["labels"]).alias("labels"))


@query
def forecast_training(spark, sf_dir):
    feed = TT.sales_feed(spark, sf_dir).select("region", "date_vente", *TIES)
    return comparable(FC.forecast_training(chronological_split(feed, TIES), TIES).drop("shard", "m2_sales"))


@query
def forecast_rmse_exact(spark, sf_dir):
    """The error of the training mean as the prediction, from the summed cells."""
    feed = TT.sales_feed(spark, sf_dir).select("region", "date_vente", *TIES)
    cells = FC.forecast_training(chronological_split(feed, TIES), TIES, FC.SHARDS)
    total, n = F.sum("sum_sales").cast("double"), F.sum("n_sales")
    mean = cells.where("is_train").groupBy("region").agg((total / n).alias("predicted"))
    return FC.region_rmse(cells.where("NOT is_train").join(mean, "region"), 4)


@query
def forecast_frame(spark, sf_dir):
    return FC.forecast_frame(TT.sales_feed(spark, sf_dir))


def _forecasts(spark, sf_dir):
    feed = TT.sales_feed(spark, sf_dir).select("region", "date_vente", *TIES)
    return FC.forecast_sales(feed, TIES)


@query
def forecast(spark, sf_dir):
    return _forecasts(spark, sf_dir)


@query
def forecast_bounds(spark, sf_dir):
    """Of every forecast region whether its months lie within the sales it was trained on."""
    feed = TT.sales_feed(spark, sf_dir).select("region", "date_vente", *TIES)
    ends = feed.groupBy("region").agg(F.min("total_sales").alias("low"), F.max("total_sales").alias("high"))
    found = _forecasts(spark, sf_dir).join(ends, "region")
    months = [F.col(f"forecast_m{i}").between(F.col("low").cast("double"), F.col("high").cast("double")) for i in (1, 2, 3)]
    return found.select("region", (months[0] & months[1] & months[2] & (F.col("rmse") > 0)).alias("within"))


@query
def report_forecasts(spark, sf_dir):
    return R.forecast_report(_forecasts(spark, sf_dir))


# ── whole jobs ───────────────────────────────────────────────────────────────
@query
def job_monthly_kpi(spark, sf_dir):
    return comparable(jobs.monthly_kpis(TT.star(spark, sf_dir, dirty=True)))


@query
def job_region_kpi(spark, sf_dir):
    feed = TT.dirty_feed(spark, sf_dir).withColumnRenamed("date_vente", "invoice_date")
    return comparable(jobs.file_tables(feed, exact=True).region)


@query
def job_gate_report(spark, sf_dir):
    return comparable(jobs.gated_sales_by_region(TT.dirty_feed(spark, sf_dir)))
