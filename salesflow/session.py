"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "salesflow") -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, as the session names it in spark.checkpoint.dir.

    Only a local session without the setting gets a folder of its own, which goes with the
    process. What an application leaves below the configured folder can go when it has ended.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="salesflow-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)  # with the session nothing reads it any more
        context.setCheckpointDir(folder)
        current = context.getCheckpointDir()
    return current.rstrip("/")


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame that several later jobs start from."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it again: its lineage is cut, and columns can be read by themselves."""
    path = new_dir(df.sparkSession, name)
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame) -> DataFrame:
    """Hold a small summary so that Catalyst knows its true size when it plans the next join.

    A summary below spark.sql.autoBroadcastJoinThreshold is then broadcast; a larger one
    is joined by shuffle. Lost blocks are recomputed from the lineage.
    """
    held = df.persist()
    held.count()
    return held
