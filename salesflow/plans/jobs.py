"""The three end-to-end jobs, as lazy plans and as jobs that write their tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow import schema as S
from salesflow.functions import parsing as P
from salesflow.operators import clean as C
from salesflow.operators import kpis as K
from salesflow.operators import quality as Q
from salesflow.operators import reports as R
from salesflow.operators.forecast import forecast_sales
from salesflow.operators.normalize import add_month, detect_roles
from salesflow.operators.segments import segment_retailers
from salesflow.operators.star import NATURAL_KEYS, Star, load_fact, members_of, star_join, upsert_dimension, upsert_stored
from salesflow.session import checkpointed, written
from salesflow.sources.readers import read_table
from salesflow.sources.sinks import drop_columns, export_table, replace_table, stamped, write_keyed
from salesflow.sources.versions import VersionedTable
from salesflow.streaming.gate import StreamGate, numbered


def monthly_kpis(star: Star) -> DataFrame:
    """Star join, cleaning and monthly KPIs.

    Facts are distinct by their identity, so no row is deduplicated; they are cleaned and
    summed by their ids, and only the sums are joined to the names.
    """
    return R.monthly_kpis(star, C.clean_facts(star.fact))


@dataclass(frozen=True)
class FileTables:
    clean: DataFrame
    region: DataFrame
    trend: DataFrame


def file_tables(df: DataFrame, exact: bool = False) -> FileTables:
    """Roles, cleaning, months and the two KPI tables of one sales file.

    `clean` keeps all columns of the file; sales and units are doubles in it, and are summed
    as decimals, so that the order of the rows does not matter. The rows are stored by columns
    in between: the fences read one of them, the sums three.
    """
    roles = detect_roles(df.columns, ("region", "date", "sales", "units"))
    sales, units, region = roles["sales"], roles["units"], roles["region"]
    typed = df.withColumns({c: P.to_number(P.quoted(c), S.AMOUNT) for c in (sales, units)})
    rows = C.drop_incomplete(P.nan_to_null(typed), [sales, region, units])
    rows = C.dedupe(C.non_negative(rows, [sales, units]))
    kept = C.iqr_filter(written(rows, "rows"), [sales], 1.5) if exact else C.iqr_filter_approx(rows, sales)
    dated = add_month(kept, roles["date"])
    flat = dated.select(P.quoted(region).alias("region"), P.quoted(sales).try_cast(S.SUMMED).alias("sales"), "mois")
    return FileTables(drop_columns(dated, "_date_parsed", "mois"), K.kpi_region_month(flat), K.kpi_trend(flat))


def gated_sales_by_region(records: DataFrame) -> DataFrame:
    """Gate, star load and the sales report of the batches that passed.

    The accepted rows are stored once, as both the dimensions and the facts start from them.
    """
    accepted = checkpointed(Q.gate(records, Q.score_batches(records))[0])
    dims = {d: upsert_dimension(d, members_of(accepted, d)) for d in NATURAL_KEYS}
    return R.sales_by_region(Star(fact=load_fact(accepted, dims), **dims))


def stream_star(gate: StreamGate) -> Star:
    """The star a stream gate has loaded."""
    return Star(fact=gate.table("fact"), **{d: gate.table(f"dim_{d}") for d in NATURAL_KEYS})


# ── jobs that write ──────────────────────────────────────────────────────────
def run_file_job(df: DataFrame, root: str) -> None:
    """Write the cleaned file first; both KPI tables are then computed from the stored rows."""
    spark = df.sparkSession
    roles = detect_roles(df.columns, ("region", "date", "sales", "units"))
    export_table(file_tables(df).clean, f"{root}/fait_ventes_clean")
    stored = read_table(spark, f"{root}/fait_ventes_clean")
    name = {r: c.lower().replace(" ", "_") for r, c in roles.items()}
    flat = add_month(stored, name["date"]).select(
        P.quoted(name["region"]).alias("region"), P.quoted(name["sales"]).try_cast(S.SUMMED).alias("sales"), "mois"
    )
    export_table(stamped(K.kpi_region_month(flat)), f"{root}/kpi_ventes_region")
    export_table(stamped(K.kpi_trend(flat)), f"{root}/kpi_tendance_temporelle")


def load_star(spark: SparkSession, records: DataFrame, root: str) -> Star:
    """Add unseen members to the stored dimensions, then write the facts that look their ids up in these.

    Known members keep their ids, also if two loads run at once.
    """
    dims = {d: upsert_stored(d, members_of(records, d), VersionedTable(spark, f"{root}/dim_{d}")) for d in NATURAL_KEYS}
    replace_table(load_fact(records, dims), f"{root}/fait_ventes", partition_by=["mois"])
    return Star(fact=read_table(spark, f"{root}/fait_ventes"), **dims)


def run_dataset_gate(df: DataFrame, root: str, run: str) -> bool:
    """Check a whole dataset, store the report under its run name and tell whether it may go on."""
    scored = Q.dataset_score(Q.dataset_checks(Q.profile(df)))
    write_keyed(scored.withColumn("timestamp", F.current_timestamp()), f"{root}/dq_reports", "run", run)
    return read_table(df.sparkSession, f"{root}/dq_reports/run={run}").first()["passed"]


def run_stream_job(stream: DataFrame, root: str, trees: int = 100, seq: str = "seq", partition: str | None = None,
                   batch_size: int = S.BATCH_SIZE, threshold: float = S.DQ_THRESHOLD, transport: tuple[str, ...] = (),
                   raw: bool = False) -> None:
    """Gate and load all available events; the analytics start once the load has come to its end.

    `seq` and `partition` name the columns that number the events (offset and partition of a
    topic); `transport` those that may differ between two deliveries of one event. With `raw`
    the events carry texts, which are scored as they are and typed before the load.
    """
    numbered_stream = numbered(stream, seq, partition, batch_size)
    gate = StreamGate(stream.sparkSession, root, numbered_stream.schema, star=True, seq=seq, batch_size=batch_size,
                      threshold=threshold, transport=transport, raw=raw)
    gate.run(numbered_stream)
    run_analytics_job(stream_star(gate), root, trees)


def run_analytics_job(star: Star, root: str, trees: int = 100) -> None:
    """KPIs, forecasts and segments from a stored star; the cleaned rows are stored once and read thrice."""
    spark = star.fact.sparkSession
    kept = C.clean_facts(star.fact)  # by ids, so that only what is kept meets the names
    replace_table(star_join(Star(kept, star.region, star.produit, star.retailer)), f"{root}/ventes_clean")
    rows = read_table(spark, f"{root}/ventes_clean")
    replace_table(stamped(kpi_table(K.kpi_monthly(rows))), f"{root}/kpis_agreg")
    forecasts = forecast_sales(rows, rows.columns, trees=trees)
    replace_table(stamped(forecasts), f"{root}/ml_forecasts")
    replace_table(segment_retailers(K.retailer_features(rows)), f"{root}/segments_retailers")


def kpi_table(kpis: DataFrame) -> DataFrame:
    """Monthly KPIs under the stored types."""
    money = {c: F.col(c).cast("decimal(24,2)") for c in ("ca_total", "profit_total", "unites_total")}
    return kpis.select(
        "mois", "region", "product",
        *[e.alias(c) for c, e in money.items()],
        F.col("panier_moyen").cast("decimal(10,4)").alias("panier_moyen"),
        F.col("marge_pct").cast("decimal(6,2)").alias("marge_pct"),
        F.col("nb_transactions").cast("int").alias("nb_transactions"),
    )
