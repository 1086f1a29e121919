"""The gate on a stream: equal to the batch gate, safe under replays."""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from salesflow.operators import kept as KV
from salesflow.operators import quality as Q
from salesflow.operators import reports as R
from salesflow.plans import jobs
from salesflow.plans.queries import _in_parts, _kept_sums
from salesflow.sources import testtables as TT
from salesflow.streaming import events as EV
from salesflow.streaming.gate import BATCH, StreamGate, numbered

EVENTS = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def events(spark):
    return TT.table(spark, EVENTS, "events")


@pytest.fixture(scope="module")
def expected(events):
    rows = numbered(TT.event_sales(events))
    log = Q.dq_log(Q.score_batches(rows, BATCH), BATCH)
    return rows, log, Q.gate(rows, log, BATCH)


def write_parts(events, folder, parts=7, start=0):
    """Files of uneven size, in sequence order, whose borders cut quality batches."""
    total = events.count()
    cuts = [total * i // parts + (13 * i) % 50 for i in range(parts)] + [total]
    cuts[0] = 0
    for i in range(parts):
        part = events.where((F.col("event_id") >= cuts[i]) & (F.col("event_id") < cuts[i + 1]))
        part.coalesce(1).write.mode("append").parquet(folder)
        for name in os.listdir(folder):
            path = os.path.join(folder, name)
            if name.endswith(".parquet") and os.path.getmtime(path) > 2e9 - 1e9 and not os.path.exists(path + ".seen"):
                stamp = 1.6e9 + (start + i) * 10
                os.utime(path, (stamp, stamp))
                open(path + ".seen", "w").close()


def gate_on(spark, root, folder, schema, star=False):
    stream = numbered(TT.event_sales(EV.stream_table(spark, folder, "*.parquet", schema, files_per_trigger=1)))
    return StreamGate(spark, root, stream.schema, star=star), stream


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def comparable(log):
    return log.withColumn("details", F.to_json("details")).drop("checked_at")


def test_stream_equals_batch(spark, events, expected, tmp_path):
    write_parts(events, str(tmp_path / "in"))
    gate, stream = gate_on(spark, str(tmp_path / "out"), str(tmp_path / "in"), events.schema)
    gate.run(stream)
    rows, log, (passed, rejected) = expected
    slices = lambda table: sorted(os.listdir(tmp_path / "out" / table))
    assert [f"mb={i}" for i in range(7)] == [x for x in slices("dq_log") if "." not in x]  # one micro-batch per file
    assert slices("open") == ["mb=5", "mb=6"]  # spent ones are deleted
    assert gate.table("dq_log").count() == 100
    assert same(comparable(gate.table("dq_log")), comparable(log))
    assert same(gate.table("accepted"), passed)
    assert gate.table("rejects").count() == rejected.count()


def test_replay_changes_nothing(spark, events, expected, tmp_path):
    gate = StreamGate(spark, str(tmp_path), numbered(TT.event_sales(events)).schema)
    rows = expected[0]
    parts = [rows.where("seq < 1250"), rows.where("seq >= 1250 and seq < 1275"), rows.where("seq >= 1275")]
    for mb, part in enumerate(parts):
        gate.process(part, mb)
        gate.process(part, mb)  # delivered again
    gate.flush()
    gate.flush()
    assert same(comparable(gate.table("dq_log")), comparable(expected[1]))
    assert same(gate.table("accepted"), expected[2][0])


def test_any_order_gives_each_batch_once(spark, events, expected, tmp_path):
    gate = StreamGate(spark, str(tmp_path), numbered(TT.event_sales(events)).schema)
    rows = expected[0]
    for mb, part in enumerate(["seq >= 4500", "seq < 450", "seq >= 450 and seq < 2000", "seq >= 2000 and seq < 4500"]):
        gate.process(rows.where(part), mb)
    gate.flush()
    assert gate.table("dq_log").count() == 100
    assert same(comparable(gate.table("dq_log")), comparable(expected[1]))
    assert same(gate.table("accepted"), expected[2][0])


def test_late_rows_score_their_batch_anew(spark, events, tmp_path):
    rows = numbered(TT.event_sales(events)).where("seq < 300")
    gate = StreamGate(spark, str(tmp_path), rows.schema)
    gate.process(rows.where("seq < 120"), 0)
    gate.flush()
    assert sorted(r.total_rows for r in gate.table("dq_log").collect()) == [20, 100]
    gate.process(rows.where("seq >= 120"), 1)
    gate.process(rows.where("seq >= 120"), 1)
    gate.process(rows.where("seq = 7"), 2)  # delivered again
    gate.flush()
    assert sorted(r.total_rows for r in gate.table("dq_log").collect()) == [100, 100, 101]
    assert gate.table("accepted").count() + gate.table("rejects").count() == 301


def test_a_new_offset_is_no_new_event(spark, events, tmp_path):
    rows = numbered(TT.event_sales(events).withColumn("offset", F.col("seq")), "offset").where("offset < 100")
    again = rows.where("seq < 10").withColumn("offset", F.col("seq") + 90).where("offset < 100")
    gate = StreamGate(spark, str(tmp_path), rows.schema, seq="offset", transport=("offset",))
    gate.process(rows.where("offset < 90").unionByName(again), 0)
    assert gate.table("dq_log").first()["details"]["no_duplicate_rows"] == 90.0


def test_merged_dimensions_keep_their_ids(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr("salesflow.streaming.gate.MERGE_AFTER", 2)
    records = TT.sales_feed(spark, small).withColumn("seq", F.dense_rank().over(Window.orderBy(*TT.FEED_KEYS)) - 1)
    rows = numbered(records.drop("batch_no")).persist()
    gate = StreamGate(spark, str(tmp_path), rows.schema, star=True)
    for mb in range(5):
        part = rows.where(f"seq >= {mb * 200} and seq < {mb * 200 + 200}")
        gate.process(part, mb)
        gate.process(part, mb)
    retailer = gate.table("dim_retailer")
    assert any(n.startswith("mb=") for n in os.listdir(tmp_path / "merged_retailer"))
    assert retailer.count() == retailer.select("retailer_id").distinct().count()
    assert same(retailer.select("retailer_name"), rows.where("seq < 1000").select(F.col("retailer").alias("retailer_name")).distinct())
    assert gate.table("fact").where("retailer_id is null").count() == 0


def test_partial_batch_waits_for_the_flush(spark, events, tmp_path):
    gate = StreamGate(spark, str(tmp_path), numbered(TT.event_sales(events)).schema)
    rows = numbered(TT.event_sales(events)).where("seq < 237")
    gate.process(rows, 0)
    assert gate.table("dq_log").count() == 2
    gate.flush()
    assert sorted(r.total_rows for r in gate.table("dq_log").collect()) == [37, 100, 100]


def test_source_partitions_are_batched_apart(spark, events, tmp_path):
    records = TT.event_sales(events).where("seq < 1000")
    split = records.withColumn("part", F.col("seq") % 2).withColumn("offset", F.floor(F.col("seq") / 2))
    rows = numbered(split, "offset", "part")
    gate = StreamGate(spark, str(tmp_path), rows.schema, seq="offset")
    gate.process(rows.where("seq < 333"), 0)
    gate.process(rows.where("seq >= 333"), 1)
    gate.flush()
    log = gate.table("dq_log")
    assert log.count() == 10 and {r.total_rows for r in log.collect()} == {100}
    assert same(comparable(log), comparable(Q.dq_log(Q.score_batches(rows, BATCH), BATCH)))


def test_star_load_per_micro_batch(spark, small, tmp_path):
    records = TT.sales_feed(spark, small).withColumn("seq", F.col("o_orderkey") * 4)
    rows = numbered(records.drop("batch_no"))
    gate = StreamGate(spark, str(tmp_path), rows.schema, star=True)
    gate.process(rows.where("seq < 2000"), 0)
    gate.process(rows.where("seq >= 2000"), 1)
    gate.process(rows.where("seq >= 2000"), 1)
    gate.flush()
    fact, region = gate.table("fact"), gate.table("dim_region")
    product, retailer = gate.table("dim_produit"), gate.table("dim_retailer")
    assert fact.count() == records.count()
    assert region.count() == 5 and region.select("region_id").distinct().count() == 5
    assert product.count() == product.select("produit_id").distinct().count()
    assert retailer.count() == records.select("retailer").distinct().count()
    named = fact.join(region, "region_id").groupBy(F.col("region_name").alias("region")).agg(F.sum("total_sales").alias("ca"))
    assert same(named, records.groupBy("region").agg(F.sum("total_sales").alias("ca")))
    assert gate.table("fact").where("produit_id is null or retailer_id is null").count() == 0


def test_events_round_trip(spark, small, tmp_path):
    feed = TT.sales_feed(spark, small)
    events = EV.to_events(feed, "b1")
    back = EV.decode(events, feed.schema)
    assert same(back.select(*feed.columns), feed)
    assert back.select("batch_id").distinct().collect() == [("b1",)]


def test_nan_text_in_events_becomes_null(spark):
    schema = TT.event_sales(spark.sql(
        "select 1L event_id, timestamp_ntz'2024-01-01' ts, 1L user_id, 'a' event_type, 1.0D value, '{}' props"
    )).select("units_sold", "total_sales").schema
    raw = spark.createDataFrame([('{"units_sold": NaN, "total_sales": 2.5}',)], "value string")
    row = EV.decode(raw, schema).first()
    assert (row.units_sold, float(row.total_sales)) == (None, 2.5)


def test_redelivered_events_are_dropped_across_micro_batches(spark, events, tmp_path):
    """The newest files come first; nothing is lost, whatever its time."""
    folder, rows = str(tmp_path / "in"), events.where("event_id < 600")
    for part in ("event_id >= 450", "event_id >= 300 and event_id < 450", "event_id < 300", "event_id >= 250 and event_id < 350"):
        rows.where(part).coalesce(1).write.mode("append").parquet(folder)
    stream = TT.event_sales(EV.stream_table(spark, folder, "*.parquet", events.schema, files_per_trigger=1))
    EV.run_deduplicated(stream, str(tmp_path / "out"), str(tmp_path / "ck"), ["seq"])
    out = EV.read_deduplicated(spark, str(tmp_path / "out"), stream.schema)
    assert same(out, TT.event_sales(rows))


def test_raw_events_are_scored_as_texts_and_loaded_typed(spark, tmp_path):
    columns = "seq long, invoice_date string, region string, product string, beverage_brand string, retailer string, " \
              "units_sold double, total_sales double, price_per_unit double, operating_profit double, operating_margin string"
    rows = [(i, ["2024/01/05", "1/6/2024", "Jan 7, 2024"][i % 3], "West", "Cola", "A", "R1", 2.0, 10.0, 5.0, 3.0, "31.5%")
            for i in range(250)]
    events = EV.to_events(spark.createDataFrame(rows, columns), "run-1")
    stored = EV.decode(events, spark.createDataFrame([], columns).schema).drop("batch_id", "event_time")
    numbers = numbered(stored)
    gate = StreamGate(spark, str(tmp_path), numbers.schema, star=True, raw=True)
    gate.process(numbers, 0)
    gate.flush()
    fact = gate.table("fact")
    assert fact.count() == 250 and gate.table("dq_log").where("dq_score = 100").count() == 3
    assert {str(r.date_vente) for r in fact.collect()} == {"2024-01-05", "2024-01-06", "2024-01-07"}
    assert {float(r.operating_margin) for r in fact.collect()} == {0.315}
    assert gate.table("dq_log").where("checked_at IS NOT NULL").count() == 3


def reads_of(gate):
    """What each micro-batch reads of earlier ones: (files, rows) by table."""
    seen, plain = [], gate._parquet

    def counting(schema, *paths):
        found = plain(schema, *paths)
        seen.append((paths[0].split("/")[len(gate.root.split("/"))], len(found.inputFiles()), found.count()))
        return found

    gate._parquet = counting
    return seen


def test_what_a_micro_batch_reads_does_not_grow(spark, events, tmp_path):
    """A steady feed: the twelfth micro-batch reads what the third one read, without any broadcast too."""
    rows = numbered(TT.event_sales(events), batch_size=10).persist()
    gate = StreamGate(spark, str(tmp_path), rows.schema, batch_size=10)
    seen, reads = reads_of(gate), {}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for mb in range(12):
            gate.process(rows.where(f"seq >= {mb * 35} and seq < {mb * 35 + 35}"), mb)
            reads[mb], seen[:] = sorted(seen), []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {table for table, _, _ in reads[11]} == {"open", "state"}
    for mb in (3, 5, 7, 9, 11):  # half a batch is open after each of these
        assert [rows_ for table, _, rows_ in reads[mb] if table == "open"] == [5]
        assert sum(files for _, files, _ in reads[mb]) <= sum(files for _, files, _ in reads[3])
        assert sum(files for table, files, _ in reads[mb] if table == "state") == 1  # one version of one range
    gate.flush()
    assert gate.table("dq_log").count() == 42 and gate.table("accepted").count() + gate.table("rejects").count() == 420
    assert len(os.listdir(tmp_path / "state" / "p=0" / "r=0")) == 2  # spent versions are deleted
    rows.unpersist()


def test_late_rows_read_their_slices_only(spark, events, tmp_path, monkeypatch):
    monkeypatch.setattr("salesflow.streaming.gate.RANGE", 4)
    rows = numbered(TT.event_sales(events), batch_size=10).where("seq < 400").persist()
    late = "seq % 10 = 3 and seq div 10 in (2, 17, 31)"
    gate = StreamGate(spark, str(tmp_path), rows.schema, batch_size=10)
    for mb in range(8):
        gate.process(rows.where(f"seq >= {mb * 50} and seq < {mb * 50 + 50} and not ({late})"), mb)
    gate.flush()
    seen = reads_of(gate)
    for _ in range(2):  # delivered twice
        gate.process(rows.where(f"seq div 10 in (2, 17) and {late}"), 8)
    gate.flush()
    tables = [table for table, _, _ in seen]
    assert tables.count("state") == 2 * 2 and max(rows_ for table, _, rows_ in seen if table == "state") <= 2 * 4  # two ranges
    assert set(tables) <= {"state", "accepted", "rejects", "open"}
    gate.process(rows.where(f"seq div 10 = 31 and {late}"), 9)
    want = Q.score_batches(rows, BATCH)
    assert gate.table("dq_log").count() == 40 and same(comparable(gate.table("dq_log")), comparable(Q.dq_log(want, BATCH)))
    accepted, rejected = Q.gate(rows, Q.dq_log(want, BATCH), BATCH)
    assert same(gate.table("accepted"), accepted) and gate.table("rejects").count() == rejected.count()
    rows.unpersist()


def deduplicated(spark, tmp_path, parts, schema, monkeypatch=None):
    """The rows of run_deduplicated over micro-batches, and the stored slices that each of them read."""
    folder, read = str(tmp_path / "in"), []
    for i, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(folder)
        for name in os.listdir(folder):
            if name.endswith(".parquet") and not os.path.exists(f"{folder}/{name}.seen"):
                os.utime(f"{folder}/{name}", (1.6e9 + 10 * i, 1.6e9 + 10 * i))
                open(f"{folder}/{name}.seen", "w").close()
    stream = EV.stream_table(spark, folder, "*.parquet", schema, files_per_trigger=1)
    plain = EV._stored
    monkeypatch.setattr(EV, "_stored", lambda spark, schema, paths: read.append(sorted(paths)) or plain(spark, schema, paths))
    EV.run_deduplicated(stream, str(tmp_path / "out"), str(tmp_path / "ck"), ["seq"])
    return EV.read_deduplicated(spark, str(tmp_path / "out"), schema), read


def test_without_redeliveries_no_stored_row_is_read(spark, events, tmp_path, monkeypatch):
    rows = TT.event_sales(events).where("seq < 400").select("seq", "event_time").persist()
    parts = [rows.where(f"seq % 4 = {k}") for k in range(4)]  # all of the same days, interleaved
    out, read = deduplicated(spark, tmp_path, parts, rows.schema, monkeypatch)
    assert same(out, rows) and read == []
    rows.unpersist()


def test_redeliveries_read_the_slices_they_are_in(spark, tmp_path, monkeypatch):
    day = "timestamp'2024-01-01' + make_interval(0, 0, 0, seq div 100, 0, 0, seq % 100)"
    rows = spark.range(1000).selectExpr("id AS seq").selectExpr("seq", f"CASE WHEN seq % 50 = 49 THEN NULL ELSE {day} END AS event_time")
    cut = [(0, 300), (300, 600), (600, 1000), (250, 310)]
    parts = [rows.where(f"seq >= {a} and seq < {b}") for a, b in cut]
    out, read = deduplicated(spark, tmp_path, parts, rows.schema, monkeypatch)
    assert same(out, rows) and len(read) == 1
    kept = {path.split("out/")[1] for path in read[0]}
    assert kept == {"mb=0/_event_day=2024-01-03", "mb=1/_event_day=2024-01-04", "mb=0/_event_day=__HIVE_DEFAULT_PARTITION__"}


def test_equal_digests_are_no_redelivery(spark, tmp_path, monkeypatch):
    """With a digest of two values everything is met again, and the keys decide."""
    monkeypatch.setattr(EV, "_digest", lambda keys: F.pmod(F.col(keys[0]), F.lit(2)))
    rows = spark.range(200).selectExpr("id AS seq", "timestamp'2024-01-01' AS event_time")
    out, read = deduplicated(spark, tmp_path, [rows.where("seq < 100"), rows.where("seq >= 90")], rows.schema, monkeypatch)
    assert same(out, rows) and len(read) == 1


def test_kept_views_equal_the_batch_views(spark, small, tmp_path, monkeypatch):
    """After late rows, replays and merges the sums give the views of the facts that hold."""
    monkeypatch.setattr("salesflow.streaming.gate.MERGE_AFTER", 3)
    records = TT.sales_feed(spark, small).where("o_orderkey < 900").withColumn("seq", F.dense_rank().over(Window.orderBy(*TT.FEED_KEYS)) - 1)
    rows = numbered(records.drop("batch_no"), batch_size=20).persist()
    late = "seq % 20 = 7 and seq div 20 in (1, 4, 9)"
    gate = StreamGate(spark, str(tmp_path), rows.schema, star=True, batch_size=20)
    cuts = [0, 70, 130, 190, 260]
    for mb in range(4):
        gate.process(rows.where(f"seq >= {cuts[mb]} and seq < {cuts[mb + 1]} and not ({late})"), mb)
    gate.flush()
    for _ in range(2):
        gate.process(rows.where(f"seq < 260 and {late}"), 4)
    star = jobs.stream_star(gate)
    assert os.path.isdir(tmp_path / "merged_sums")
    assert star.fact.count() == rows.where("seq < 260").count()
    assert same(KV.kept_region_month(gate.sums(), star), R.view_region_month(star))
    assert same(KV.kept_sales_by_month(gate.sums(), star), R.sales_by_month(star))
    assert same(KV.kept_global_kpis(gate.sums()), R.view_global_kpis(star.fact))
    assert gate.sums().agg(F.sum("n_rows")).first()[0] == star.fact.count()
    rows.unpersist()


def test_published_files_are_compressed(spark, tmp_path):
    """A topic takes less than its texts, and comes back whole."""
    topic = str(tmp_path / "topic")
    rows = spark.range(2000).select("id", F.concat(F.lit("retailer "), F.col("id") % 7).alias("retailer"))
    texts = EV.to_events(rows, "b").persist()
    EV.publish_files(texts, topic)
    size = sum(os.path.getsize(os.path.join(topic, n)) for n in os.listdir(topic) if n.startswith("part-"))
    assert 0 < size * 4 < texts.agg(F.sum(F.length("value"))).first()[0]
    assert same(EV.decode(spark.read.text(topic), rows.schema).select(*rows.columns), rows)


def test_kept_slices_read_stored_facts(spark, small):
    """The feed is joined once; every slice of the sums starts from the stored facts."""
    sums, star = _kept_sums(spark, small)
    assert all("/facts-" in f for f in star.fact.inputFiles())
    assert sums.agg(F.sum("n_rows")).first()[0] == star.fact.where(F.col("_slice").isNotNull()).count()
    assert set(star.fact.columns) == {*KV.DAY_KEYS, *KV.MEASURES, "_slice"}


def test_files_of_a_topic_follow_its_rows(spark, tmp_path):
    """A part of many splits is one file as long as its rows fit one."""
    folder = str(tmp_path / "topic")
    _in_parts(spark.range(0, 1000, 1, 8), folder, F.col("id") % 2, 2)
    assert len([n for n in os.listdir(folder) if n.startswith("part-")]) == 2
    assert spark.read.parquet(folder).count() == 1000


def test_files_of_deduplicated_slices_follow_their_rows(spark, tmp_path):
    """Few events are few files, however many partitions a shuffle has; large days are cut."""
    topic, table = str(tmp_path / "topic"), str(tmp_path / "table")
    rows = spark.range(0, 4000, 1, 8).select(F.col("id").alias("seq"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 2 * 86400).alias("event_time"))
    rows.coalesce(1).write.parquet(topic)
    files = lambda: [n for d, _, names in os.walk(table) for n in names if n.startswith("part-")]
    stream = EV.stream_table(spark, topic, "*.parquet", rows.schema)
    EV.run_deduplicated(stream, table, str(tmp_path / "checkpoint"), ["seq"])
    assert same(EV.read_deduplicated(spark, table, rows.schema), rows)
    assert len(files()) == 4  # rows and digests of two days
