"""Structured Streaming jobs. Each takes a streaming DataFrame; run() drains a source once and returns what was written."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from trawl.operators import snapshots as S
from trawl.operators.health import Breaker
from trawl.sources import sinks
from trawl.streaming.shared import scratch

# Bounds of plausible times, seconds.
EARLIEST, AHEAD, SLACK_BEFORE, SLACK_AFTER = 1_735_689_600, 600, 10, 300


#: The store that processors with state of their own need.
ROCKS = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def run(df: DataFrame, name: str, mode: str = "append", write: Callable[[DataFrame, int, str], None] | None = None, rocks: bool = False) -> DataFrame:
    """Drains the stream into a table of the shared folder and reads it; write(batch, id, path) replaces the plain writer; rocks keeps its state in RocksDB, whatever the session's setting."""
    spark = df.sparkSession
    path = scratch(spark, name)
    w = df.writeStream.outputMode(mode).option("checkpointLocation", path + "-checkpoint").trigger(availableNow=True)
    if write is None and mode == "complete":
        write = lambda b, _, p: b.write.mode("overwrite").parquet(p)  # noqa: E731  each batch holds the whole result
    before = spark.conf.get(ROCKS[0], None)
    if rocks:
        spark.conf.set(*ROCKS)
    try:
        q = w.foreachBatch(lambda b, i: write(b, i, path)).start() if write else w.format("parquet").start(path)
        q.awaitTermination()
    finally:
        if rocks:
            spark.conf.unset(ROCKS[0]) if before is None else spark.conf.set(ROCKS[0], before)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns) if write is None or sinks.exists(spark, path) else spark.createDataFrame([], df.schema)


def run_updates(df: DataFrame, name: str, keys: list[str], order: str) -> DataFrame:
    """Drains the stream in update mode: every batch appends the rows that changed, and of each key the row with the greatest order stands.

    Unlike complete mode, no batch holds the whole result, and state behind the watermark is dropped."""
    write = lambda b, i, p: b.withColumn("_batch", F.lit(i)).write.mode("append").parquet(p)
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    q = df.writeStream.outputMode("update").option("checkpointLocation", path + "-checkpoint").trigger(availableNow=True).foreachBatch(lambda b, i: write(b, i, path)).start()
    q.awaitTermination()
    schema = df.schema.add("_batch", "long")
    rows = spark.read.schema(schema).parquet(path) if sinks.exists(spark, path) else spark.createDataFrame([], schema)
    # a batch that was written twice has the same rows twice
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct("_batch", order)).alias("_row"))
    return last.select("_row.*")


def run_sessions(df: DataFrame, name: str) -> DataFrame:
    """Drains a stream of sessions() and returns all of them: the closed ones, which were written as the watermark passed, and those still open, as they stand in the state of the last batch."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    q = df.writeStream.outputMode("append").option("checkpointLocation", path + "-checkpoint").trigger(availableNow=True).format("parquet").start(path)
    q.awaitTermination()
    out = spark.read.schema(df.schema).parquet(path) if sinks.exists(spark, path) else spark.createDataFrame([], df.schema)
    if not sinks.exists(spark, path + "-checkpoint/state"):
        return out
    # a session's window, key and count, in the columns' order
    return out.union(spark.read.format("statestore").load(path + "-checkpoint").select("value.*"))


def source(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A parquet file or folder as a stream; the schema is that of the files."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    glob = f"{folder}/{name[:-1]}[{name[-1]}]" if name else path
    r = spark.readStream.schema(schema)
    return (r.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else r).parquet(glob)


def seen_once(df: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Drops repeats of a key that come within the delay; state older than that goes."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def outcome_counts(df: DataFrame, ts: str, by: list[str], bad, window: str, slide: str | None = None, delay: str = "5 minutes") -> DataFrame:
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    return df.withWatermark(ts, delay).groupBy(w, *by).agg(F.count("*").alias("n"), F.sum(bad.cast("long")).alias("bad"))


def sessions(df: DataFrame, ts: str, by: str, gap: str, delay: str = "5 minutes") -> DataFrame:
    """Sessions by gap. In append mode each comes once, when the watermark passes its end, and its state goes; those still open at the end of a drained stream stay in the state, from which run_sessions takes them."""
    return df.withWatermark(ts, delay).groupBy(F.session_window(ts, gap), by).agg(F.count("*").alias("n"))


def breaker(df: DataFrame) -> DataFrame:
    """Breaker per domain over (domain, ord, t, cls); its state is kept between batches."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        b, out = Breaker(state.get if state.exists else ("closed", 0, 0.0)), []
        for r in pd.concat(list(batches)).sort_values(["t", "ord"]).itertuples():
            out += [(key[0], r.ord, a, z) for a, z in b.step(r.t, r.cls)]
        state.update((b.state, b.streak, b.until))
        yield pd.DataFrame(out, columns=["domain", "ord", "state_from", "state_to"]).astype({"domain": "int64", "ord": "int64"})

    return df.groupBy("domain").applyInPandasWithState(step, "domain long, ord long, state_from string, state_to string", "state string, streak int, until double", "append", GroupStateTimeout.NoTimeout)


class StallAlarms(StatefulProcessor):
    """One run's mark, since when it stands, and whether that was alarmed; a timer of event time stands at the moment at which the alarm is due."""

    def __init__(self, limit: float):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("stall", "mark long, since double, alarmed boolean")

    def handleInputRows(self, key, rows, timerValues):
        mark, since, alarmed = self.state.get() if self.state.exists() else (None, None, False)
        out = []
        # one run's rows of one batch, in order
        for t, new in sorted((t, m) for pdf in rows for t, m in zip(pdf["t"].tolist(), pdf["mark"].tolist(), strict=True)):
            if since is not None and t - since >= self.limit and not alarmed:
                out.append((key[0], since + self.limit, "stall_detected"))
                alarmed = True
            if since is None or new != mark:
                if alarmed:
                    out.append((key[0], float(t), "stall_cleared"))
                mark, since, alarmed = int(new), float(t), False
        self.state.update((mark, since, alarmed))
        for due in list(self.handle.listTimers()):
            self.handle.deleteTimer(due)
        if not alarmed:
            self.handle.registerTimer(max(math.ceil((since + self.limit) * 1000), timerValues.getCurrentWatermarkInMs() + 1))
        yield self._rows(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        mark, since, alarmed = self.state.get()
        self.state.update((mark, since, True))
        yield self._rows([] if alarmed else [(key[0], since + self.limit, "stall_detected")])

    def close(self) -> None:
        pass

    @staticmethod
    def _rows(out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=["run", "t", "event"]).astype({"run": "int64", "t": "float64"})


def stall_alarms(df: DataFrame, limit: float = 900, delay: str = "0 seconds") -> DataFrame:
    """(run, t, mark) -> one alarm when a mark hasn't changed for limit seconds, one 'cleared' when it does again. Run it with rocks.

    A run that falls silent raises its alarm by a timer: when the watermark, which rows of other runs move on, passes the limit."""
    timed = df.withColumn("ts", F.timestamp_seconds("t")).withWatermark("ts", delay)
    return timed.groupBy("run").transformWithStateInPandas(statefulProcessor=StallAlarms(limit), outputStructType="run long, t double, event string", outputMode="Append", timeMode="EventTime")


def plausible(df: DataFrame, t: str, now: float, earliest: float = EARLIEST) -> tuple[DataFrame, DataFrame]:
    """(rows with a plausible time, the others)."""
    ok = F.coalesce(F.col(t).between(earliest, now + AHEAD), F.lit(False))
    return df.where(ok), df.where(~ok)


def append_new(keys: list[str]) -> Callable[[DataFrame, int, str], None]:
    """A writer for run(): appends unseen keys only, so a replayed batch adds nothing."""
    return lambda batch, _, path: sinks.append_new(batch, path, keys)


VERSIONS = StructType().add("site_id", "string").add("ord", "long").add("sha", "string").add("ver", "long")


def captures_into(batch: DataFrame, i: int, path: str) -> None:
    """A writer for run(): the batch's rows in a folder of its own, which a batch that comes again replaces. Captures may come in any order, as files do; versions are taken from what lies there."""
    batch.write.mode("overwrite").parquet(f"{path}/batch={i}")


def versions_into(batch: DataFrame, _: int, path: str) -> None:
    """A writer for run(): new captures (site_id, ord, sha) as versions, going on from each site's last one. For captures that come in order of ord: one that comes behind a later one of its site is not a new one here (see captures_into). Only the buckets of the batch's sites are read; a batch that comes again adds nothing."""
    spark = batch.sparkSession
    batch = batch.select("site_id", "ord", "sha", sinks.bucket_of(["site_id"]).alias(sinks.BUCKET))
    old = sinks.in_buckets(spark, path, VERSIONS, sinks.touched(batch))
    last = old.groupBy("site_id").agg(F.max_by(F.struct("ord", "sha", "ver"), "ver").alias("l")).select("site_id", "l.ord", "l.sha", F.col("l.ver").alias("old_ver"))
    new = batch.join(last.select("site_id", F.col("ord").alias("old_ord")), "site_id", "left").where("old_ord IS NULL OR ord > old_ord")
    both = new.select("site_id", "ord", "sha", F.lit(None).cast("long").alias("old_ver")).unionByName(last)
    v = S.versions(both).join(last.select("site_id", F.col("old_ver").alias("from_ver")), "site_id", "left")
    v = v.where("is_new = 1 AND old_ver IS NULL").select("site_id", "ord", "sha", (F.col("ver") + F.coalesce(F.col("from_ver") - 1, F.lit(0))).alias("ver"))
    sinks.into_buckets(v.withColumn(sinks.BUCKET, sinks.bucket_of(["site_id"])), path)
