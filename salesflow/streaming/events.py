"""Sales events: publishing records as JSON, reading them back, dropping redeliveries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.functions.parsing import quoted

DAY = "_event_day"
DIGEST = "_event_digest"
#: Rows of a day that go to one file of a slice.
FILE_ROWS = 500_000


def to_events(df: DataFrame, batch_id: str, event_time: Column | None = None) -> DataFrame:
    """Each record as one JSON text with the run's batch id and an event time; NULL fields are left out."""
    stamp = F.current_timestamp() if event_time is None else event_time
    fields = df.withColumns({"batch_id": F.lit(batch_id), "event_time": stamp})
    return fields.select(F.to_json(F.struct(*fields.columns)).alias("value"))


def publish_files(events: DataFrame, path: str, files: int | None = None) -> None:
    """Write events as compressed text files, one JSON object per line; a stand-in for a topic."""
    (events.repartition(files) if files else events).write.mode("overwrite").option("compression", "gzip").text(path)


def publish_kafka(events: DataFrame, servers: str, topic: str) -> None:
    """Send events to a topic; needs the Kafka package on the classpath."""
    (
        events.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.retries", 3)
        .option("topic", topic)
        .save()
    )


def event_schema(record_schema: T.StructType) -> T.StructType:
    fields = [*record_schema.fields, T.StructField("batch_id", T.StringType()),
              T.StructField("event_time", T.TimestampType())]
    return T.StructType(fields)


def decode(events: DataFrame, record_schema: T.StructType) -> DataFrame:
    """JSON texts (batch or stream) back to typed columns."""
    parsed = F.from_json(F.col("value").cast("string"), event_schema(record_schema))
    return events.select(parsed.alias("e"), *[c for c in events.columns if c != "value"]).select(
        "e.*", *[c for c in events.columns if c != "value"]
    )


def stream_files(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Stream of event files, oldest first."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def stream_table(spark: SparkSession, folder: str, pattern: str, schema: T.StructType,
                 files_per_trigger: int = 1000) -> DataFrame:
    """Stream of the parquet files of a folder whose names match a pattern."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )


def run_deduplicated(stream: DataFrame, path: str, checkpoint: str, keys: list[str],
                     event_time: str = "event_time") -> None:
    """Drain everything available into a table that holds each event once, in whatever order events arrive.

    A redelivered event has the time of the first delivery. Beside the rows, every micro-batch
    stores a 64-bit digest of its keys per event day, in a folder named by the first and last
    event time in it. A micro-batch looks into the digests only where these times overlap its
    own, and reads stored rows only of the slices and days where a digest is met again; the keys
    decide. So nothing is ever too late, and without redeliveries no stored row is read. Every
    micro-batch is a slice of its own, and a replay writes the slice anew.
    """
    spark = stream.sparkSession
    digests = T.StructType([T.StructField(DIGEST, T.LongType())])

    def store(rows: DataFrame, mb: int) -> None:
        fresh = rows.dropDuplicates(keys).withColumns({DAY: F.to_date(event_time), DIGEST: _digest(keys)}).persist()
        times = F.unix_micros(F.col(event_time).cast("timestamp"))
        days = fresh.groupBy(DAY).agg(F.min(times).alias("low"), F.max(times).alias("high"), F.count("*").alias("n")).collect()  # calendar days
        met = [(r[DAY], k, there) for r in days for k, low, high, there in _digest_slices(spark, path, r[DAY])
               if k < mb and (low is None or (low <= r["high"] and r["low"] <= high))]
        if met:
            known = spark.read.schema(digests).parquet(*[there for _, _, there in met])
            again = fresh.join(known.withColumn("_slice", F.col("_metadata.file_path")), DIGEST)
            hit = {r["_folder"] for r in again.select(F.regexp_extract("_slice", "(day=[^/]*/v=[^/]*)", 1).alias("_folder")).distinct().collect()}
            where = [f"{path}/mb={k}/{DAY}={_folder(day)}" for day, k, there in met if "/".join(there.split("/")[-2:]) in hit]
            if where:
                known_keys = _stored(spark, T.StructType([f for f in stream.schema.fields if f.name in keys]), where)
                left = fresh.join(known_keys, keys, "left_anti").persist()
                left.count()
                fresh.unpersist()
                fresh = left
                days = fresh.groupBy(DAY).agg(F.min(times).alias("low"), F.max(times).alias("high"), F.count("*").alias("n")).collect()
        _by_day(fresh, DAY, days).drop(DIGEST).write.mode("overwrite").partitionBy(DAY).parquet(f"{path}/mb={mb}")
        if days:
            named = spark.createDataFrame([(r[DAY], _folder(r[DAY]), f"{mb}_{r['low']}_{r['high']}") for r in days],
                                          T.StructType([T.StructField(DAY, T.DateType()), T.StructField("day", T.StringType()),
                                                        T.StructField("v", T.StringType())]))
            kept = fresh.select(DAY, DIGEST).join(named, fresh[DAY].eqNullSafe(named[DAY])).select("day", "v", DIGEST)
            _by_day(kept, "day", days).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                "day", "v").parquet(f"{path}/_digests")
        fresh.unpersist()

    query = (
        stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _by_day(rows: DataFrame, day: str, days: list) -> DataFrame:
    """Rows dealt by day, and large days in pieces by digest, so that the files of a slice follow its size."""
    pieces = 1 + max((r["n"] for r in days), default=0) // FILE_ROWS
    return rows.repartition(day, F.pmod(DIGEST, F.lit(pieces)))


def _digest(keys: list[str]) -> Column:
    return F.xxhash64(*[quoted(k) for k in keys])


def _stored(spark: SparkSession, schema: T.StructType, paths: list[str]) -> DataFrame:
    """Some columns of stored slices, each of one micro-batch and day."""
    return spark.read.schema(schema).parquet(*paths)


def _folder(day) -> str:
    """The name under which a partitioned table keeps a day."""
    return "__HIVE_DEFAULT_PARTITION__" if day is None else str(day)


def _digest_slices(spark: SparkSession, path: str, day) -> list[tuple[int, int | None, int | None, str]]:
    """(micro-batch, first time, last time, path) of the digests of a day; events without a time have none."""
    name = f"{path}/_digests/day={_folder(day)}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(name)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    found = []
    for status in fs.listStatus(folder):
        version = status.getPath().getName()
        mb, low, high = version.removeprefix("v=").split("_")
        ends = (None, None) if low == "None" else (int(low), int(high))
        found.append((int(mb), *ends, f"{name}/{version}"))
    return found


def read_deduplicated(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The events of such a table."""
    stored = T.StructType([*schema.fields, T.StructField(DAY, T.DateType()), T.StructField("mb", T.LongType())])
    return spark.read.schema(stored).parquet(path).drop(DAY, "mb")


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Drain everything available into a parquet table, exactly once."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
