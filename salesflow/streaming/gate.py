"""The quality gate on a stream.

Records are numbered at the source (`seq`, such as a topic offset), so quality batches are
fixed by the numbers and neither by the order in which files arrive nor by where
micro-batches end. Each micro-batch adds its rows to those still open, scores the batches all
of whose numbers are there, and carries the rest over. Rows of a batch that has been scored
already (the rest of one that was flushed, or a redelivery) bring its earlier rows back and
the batch is scored again; readers see the newest score of each batch and its rows only.

All outputs of a micro-batch are slices keyed by its id, and a replay overwrites them with
the same rows. Spent slices of open rows are deleted, dimension slices are merged from time
to time.

Which slice a scored batch lies in is kept as state, by source partition and range of batch
numbers. A version of a range has the first and last scored batch in its folder name, so a
micro-batch reads the state only of ranges in which it overlaps scored batches, and of the
output tables only the slices its batches lie in. What a micro-batch reads therefore does not
grow with the history. Rows of batches that were scored anew are listed apart (`superseded`):
that list is all that readers hold the tables against.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow import schema as S
from salesflow.operators.kept import merged_sums, slice_sums
from salesflow.operators.normalize import to_records
from salesflow.operators.quality import dq_log, gate, score_batches
from salesflow.operators.star import NATURAL_KEYS, load_fact, members_of, new_members
from salesflow.sources.sinks import write_keyed

BATCH = ["source_partition", "batch_no"]
#: Dimension slices that are read one by one before they are merged.
MERGE_AFTER = 20
#: Batches of a range of the state.
RANGE = 10_000
STATE = T.StructType([*[T.StructField(c, T.LongType()) for c in BATCH], T.StructField("slice", T.DoubleType())])


def numbered(stream: DataFrame, seq: str = "seq", partition: str | None = None,
             batch_size: int = S.BATCH_SIZE) -> DataFrame:
    """Add the batch key of each record from its sequence number."""
    return stream.withColumns(
        {
            "source_partition": F.col(partition).cast("long") if partition else F.lit(0).cast("long"),
            "batch_no": F.call_function("div", F.col(seq), F.lit(batch_size)),
        }
    )


@dataclass
class StreamGate:
    """Gate whose tables live below `root`, a folder all executors reach.

    `seq` and `batch_size` are those the stream was numbered with. Columns in `transport` (offset,
    partition, timestamp) do not tell two deliveries of one event apart. With `raw` the rows
    are scored as they come and turned into typed sales records before they are loaded.
    """

    spark: SparkSession
    root: str
    schema: T.StructType
    star: bool = False
    seq: str = "seq"
    batch_size: int = S.BATCH_SIZE
    threshold: float = S.DQ_THRESHOLD
    transport: tuple[str, ...] = ()
    raw: bool = False

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def run(self, stream: DataFrame, flush: bool = True) -> None:
        """Drain the available input, then score the last partial batches unless more is to come."""
        query = (
            stream.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", self.path("_checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        if flush:
            self.flush()

    def process(self, rows: DataFrame, mb: int) -> None:
        """One micro-batch: score what is complete or was scored before, carry the rest."""
        pool = rows.select(*self.schema.names)
        before = self._slices("open", mb, self.schema, only_last=True)
        if before is not None:
            pool = pool.unionByName(before)
        fresh = pool = pool.persist()
        again = self._scored(pool, mb)
        if again is not None:
            for table in ("accepted", "rejects"):
                earlier = self._among(table, [r["slice"] for r in again.select("slice").distinct().collect()])
                pool = pool.unionByName(earlier.join(again, [*BATCH, "slice"], "left_semi").drop("slice"))
            pool = pool.persist()  # over the rows held above
        sizes = pool.groupBy(*BATCH).agg(F.count_distinct(self.seq).alias("numbers"))
        complete = sizes.where(F.col("numbers") >= self.batch_size).select(*BATCH)
        if again is not None:
            complete = complete.union(again.select(*BATCH)).distinct()
        complete = complete.persist()
        self._emit(pool.join(complete, BATCH, "left_semi"), mb, again)
        write_keyed(pool.join(complete, BATCH, "left_anti"), self.path("open"), "mb", mb)
        self._remember(complete, again, mb)
        self._delete("open", sorted(k for k in self._keys("open") if k < mb)[:-1])
        for held in (complete, pool, *([] if again is None else [again, fresh])):
            held.unpersist()

    def flush(self) -> None:
        """Score the batches still open at the end of the input."""
        keys = self._keys("open")
        if not keys:
            return
        last = int(max(keys))
        rest = self._slices("open", last + 1, self.schema, only_last=True).persist()
        rest.count()
        if not rest.isEmpty():
            # Half-way between two micro-batches, so that a later run keeps its own slices.
            self._emit(rest, f"{last}.5")
            self._remember(rest.select(*BATCH).distinct(), None, f"{last}.5")
            write_keyed(self.spark.createDataFrame([], rest.schema), self.path("open"), "mb", last)
        rest.unpersist()

    def _emit(self, done: DataFrame, mb: int | str, again: DataFrame | None = None) -> None:
        scores = score_batches(done, BATCH, threshold=self.threshold, ignore=list(self.transport))
        log = dq_log(scores, BATCH).withColumn("checked_at", F.current_timestamp())
        write_keyed(log, self.path("dq_log"), "mb", mb)
        written = self.spark.read.schema(log.schema).parquet(f"{self.path('dq_log')}/mb={mb}")
        accepted, rejected = gate(done, written, BATCH)
        write_keyed(accepted, self.path("accepted"), "mb", mb)
        write_keyed(rejected, self.path("rejects"), "mb", mb)
        if self.star:
            self._load_star(mb, again)

    def _load_star(self, mb: int | str, again: DataFrame | None) -> None:
        """Add the new dimension members, the facts of one slice, and what they change in the kept sums."""
        rows = self.spark.read.schema(self.schema).parquet(f"{self.path('accepted')}/mb={mb}")
        if self.raw:
            rows = to_records(rows)
        dims = {}
        for name in NATURAL_KEYS:
            existing = self._dimension(name, mb)
            fresh = new_members(name, members_of(rows, name), existing)
            write_keyed(fresh, self.path(f"dim_{name}"), "mb", mb)
            added = self.spark.read.schema(fresh.schema).parquet(f"{self.path(f'dim_{name}')}/mb={mb}")
            dims[name] = added if existing is None else existing.select(*added.columns).unionByName(added)
            self._merge(f"dim_{name}", f"merged_{name}", dims[name], mb)
        fact = load_fact(rows, dims, keep=BATCH)
        write_keyed(fact, self.path("fact"), "mb", mb, partition_by=["mois"])
        change = slice_sums(self._parquet(fact.schema, f"{self.path('fact')}/mb={mb}"))
        if again is not None:
            slices = [r["slice"] for r in again.select("slice").distinct().collect()]
            spent = self._among("fact", slices, fact.schema).join(again, [*BATCH, "slice"], "left_semi")
            change = change.unionByName(slice_sums(spent, -1))
        write_keyed(change, self.path("sums"), "mb", mb)
        self._merge("sums", "merged_sums", self._kept("sums", "merged_sums", str(mb), including=True), mb)

    def sums(self) -> DataFrame:
        """The sums of all facts that hold, from the sums of their slices."""
        return merged_sums(self._kept("sums", "merged_sums", float("inf")))

    def table(self, name: str) -> DataFrame:
        """An output table: of batches scored more than once the newest rows."""
        if name.startswith("dim_"):
            return self._dimension(name.removeprefix("dim_"), float("inf"))
        stored = self.spark.read.parquet(self.path(name)).withColumn("slice", F.col("mb").cast("double")).drop("mb")
        if self._keys("superseded"):
            stored = stored.join(self.spark.read.schema(STATE).parquet(self.path("superseded")), [*BATCH, "slice"], "left_anti")
        return stored.drop("slice")

    # ── which slice a scored batch lies in ──
    def _versions(self, part: int, place: int, below: float) -> list[tuple[float, int, int, str]]:
        """(key, first batch, last batch, path) of the versions of a range, oldest first."""
        folder, fs = self._folder(f"state/p={part}/r={place}")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        found = [(*n.removeprefix("v=").split("_"), f"{self.path('state')}/p={part}/r={place}/{n}") for n in names if n.startswith("v=")]
        return sorted((float(k), int(low), int(high), path) for k, low, high, path in found if float(k) < below)

    def _ranges(self, batches: DataFrame) -> list:
        """Source partition, range, first and last batch number for every range that some batches are in."""
        place = F.call_function("div", F.col("batch_no"), F.lit(RANGE)).alias("r")
        return batches.dropna(subset=BATCH).groupBy(F.col("source_partition").alias("p"), place).agg(
            F.min("batch_no").alias("low"), F.max("batch_no").alias("high")).collect()

    def _scored(self, pool: DataFrame, mb: int) -> DataFrame | None:
        """The batches of some rows that were scored before a slice, and the slice each lies in; None if there are none."""
        paths = []
        for r in self._ranges(pool):
            for _, low, high, path in self._versions(r["p"], r["r"], mb)[-1:]:
                if low <= r["high"] and r["low"] <= high:
                    paths.append(path)
        if not paths:
            return None
        again = self._parquet(STATE, *paths).join(pool.select(*BATCH).distinct(), BATCH, "left_semi").persist()
        if again.isEmpty():
            again.unpersist()
            return None
        return again

    def _remember(self, scored: DataFrame, again: DataFrame | None, mb: int | str) -> None:
        """Write the next version of every range with newly scored batches, and the rows these supersede."""
        ranges = self._ranges(scored)
        spent, known, names = [], [], []
        for r in ranges:
            before = self._versions(r["p"], r["r"], float(mb))
            spent += [path for _, _, _, path in before[:-1]]
            known += [path for _, _, _, path in before[-1:]]
            low, high = min([r["low"], *(v[1] for v in before[-1:])]), max([r["high"], *(v[2] for v in before[-1:])])
            names.append((r["p"], r["r"], f"{mb}_{low}_{high}"))
        if not ranges:
            return
        now = scored.dropna(subset=BATCH).withColumn("slice", F.lit(float(mb)))
        if known:
            earlier = self._parquet(STATE, *known).join(scored, BATCH, "left_anti")
            now = earlier.select(*now.columns).unionByName(now)
        place = F.call_function("div", F.col("batch_no"), F.lit(RANGE))
        keyed = now.withColumns({"p": F.col("source_partition"), "r": place})
        named = self.spark.createDataFrame(names, "p long, r long, v string")
        keyed.join(named, ["p", "r"]).hint("rebalance", "p", "r").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "p", "r", "v").parquet(self.path("state"))
        if again is not None:
            write_keyed(again.select(*BATCH, "slice"), self.path("superseded"), "mb", mb)
        for path in spent:
            self._remove(path)

    def _among(self, table: str, slices: list[float], schema: T.StructType | None = None) -> DataFrame:
        """Some slices of a table, read by their paths, with the key as `slice`."""
        keyed = [self._parquet(schema or self.schema, f"{self.path(table)}/mb={_text(k)}").withColumn("slice", F.lit(k)) for k in sorted(slices)]
        found = keyed[0]
        for more in keyed[1:]:
            found = found.unionByName(more)
        return found

    def _parquet(self, schema: T.StructType, *paths: str) -> DataFrame:
        """What a micro-batch reads of earlier slices, all of it by their paths."""
        return self.spark.read.schema(schema).parquet(*paths)

    def _dimension(self, name: str, below: int | str | float) -> DataFrame | None:
        """The members known before a slice."""
        return self._kept(f"dim_{name}", f"merged_{name}", below)

    def _kept(self, table: str, merged: str, below: int | str | float, including: bool = False) -> DataFrame | None:
        """The rows of all slices before one (or up to it): the last merged table and the slices after it."""
        last = max((k for k in self._keys(merged) if k < float(below)), default=None)
        after = self._slices(table, float(below) + (0.25 if including else 0), above=last)  # keys are whole numbers and halves
        if last is None:
            return after
        whole = self.spark.read.parquet(f"{self.path(merged)}/mb={_text(last)}")
        return whole if after is None else whole.unionByName(after.select(*whole.columns))

    def _merge(self, table: str, into: str, rows: DataFrame, mb: int | str) -> None:
        """Write the rows of all slices as one table once there are many, and delete what only older ones need."""
        merged = sorted(k for k in self._keys(into) if k < float(mb))
        since = [k for k in self._keys(table) if not merged or k > merged[-1]]
        if len(since) >= MERGE_AFTER:
            write_keyed(rows if table != "sums" else merged_sums(rows), self.path(into), "mb", mb)
            if merged:
                self._delete(table, [k for k in self._keys(table) if k <= merged[-1]])
                self._delete(into, merged[:-1])

    def _folder(self, table: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _keys(self, table: str) -> list[float]:
        """Keys of the slices written so far, from the folder names."""
        path, fs = self._folder(table)
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
        return [float(n.removeprefix("mb=")) for n in names if n.startswith("mb=")]

    def _delete(self, table: str, keys: list[float]) -> None:
        for k in keys:
            self._remove(f"{self.path(table)}/mb={_text(k)}")

    def _remove(self, path: str) -> None:
        there = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        there.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(there, True)

    def _slices(self, table: str, below: int | str | float, schema=None, only_last: bool = False,
                above: float | None = None) -> DataFrame | None:
        """Slices with a key below the given one; with `only_last` the newest of them."""
        keys = sorted(k for k in self._keys(table) if k < float(below) and (above is None or k > above))
        if not keys:
            return None
        paths = [f"{self.path(table)}/mb={_text(k)}" for k in (keys[-1:] if only_last else keys)]
        return self.spark.read.parquet(*paths) if schema is None else self._parquet(schema, *paths)


def _text(key: float) -> str:
    return str(int(key) if key.is_integer() else key)
