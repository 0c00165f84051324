"""What the operators of this subpackage share: tables, folds, bounded samples, staged tables, connected components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by a path that only Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(col: str, n: int):
    """crc32 of the value written as text, modulo n (null for a null value)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the one named by spark.checkpoint.dir. Where that is unset and Spark runs in one process, as in local tests, a
    temporary folder is made once and set for the session; on a cluster that is an error, as executors share no local folder."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="trawl-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: later steps don't recompute it, and survive a lost executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def released(*tables: DataFrame) -> None:
    """Deletes staged tables that no later step reads."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.staged_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Keys that hold more than one in HOT of all rows: fewer than HOT by arithmetic, so that they can be broadcast.
HOT = 1024


def skew_join(left: DataFrame, right: DataFrame, key: str, count: str, total: int, how: str = "left") -> DataFrame:
    """left joined with right, which has one row for each key and the count of left's rows with it; total is left's number of rows.

    Rows of hot keys meet their match by a broadcast of fewer than HOT rows, whatever the size; the others by shuffle,
    where no key has more than one in HOT of the rows. Rows of hot keys are spread by their own hash there."""
    names = [c for c in right.columns if c != key]
    hot = right.where(F.col(count) * HOT > total).select(F.col(key).alias("_key"), F.struct(*names).alias("_hot"))
    cold = right.where(F.col(count) * HOT <= total).select(F.col(key).alias("_at"), F.struct(*names).alias("_cold"))
    out = left.join(F.broadcast(hot), left[key] == hot["_key"], "left").drop("_key")
    # a hot row's own hash may be another key: its match is the broadcast one all the same
    spread = F.xxhash64(*[left[c] for c in left.columns]).cast(left.schema[key].dataType)
    out = out.withColumn("_at", F.when(F.col("_hot").isNull(), F.col(key)).otherwise(spread)).join(cold, "_at", "left")
    found = F.coalesce("_hot", "_cold")
    out = out.where(found.isNotNull()) if how == "inner" else out
    return out.select(*[left[c] for c in left.columns], *[found[n].alias(n) for n in names])


def share(col, fraction: float):
    """A condition that holds for about this fraction of values, chosen by hash: the same rows at every run."""
    return F.pmod(F.xxhash64(col, F.lit("sample")), F.lit(1_000_003)) < int(fraction * 1_000_003) + 1


def bounded_fraction(n: int, cap: int) -> float:
    """The fraction that makes a sample of about cap rows out of n."""
    return 1.0 if n <= cap else cap / n


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph given as rows (a, b) of longs.

    Returns (node, root): root is the smallest node that can be reached. Alternating large-star and small-star
    rounds until nothing changes: each one is a minimum per node, which is summed on the map side, and a join; the state is written to
    the shared folder after every round, and the one before it deleted. No neighbourhood is ever gathered in one task or at the driver. An empty
    graph gives no rows; loops count as single nodes."""
    edges = staged(edges.select("a", "b"), "links")  # used several times below
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    edges = staged(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")

    def star(e: DataFrame, large: bool) -> DataFrame:
        # large: both directions, so that each node sees all its neighbours; small: only those below it
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = both.join(low, "u")
        if large:
            out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        return out.where("u != v").distinct()

    part = lambda a, b: F.sum(F.pmod(F.xxhash64(a, b), F.lit((1 << 31) - 1)))
    mark = None
    while True:
        new = staged(star(star(edges, True), False), "edges")
        released(edges)
        edges, now = new, new.agg(F.count("*"), part("u", "v"), part("v", "u")).first()
        if now == mark:
            break
        mark = now
    roots = edges.groupBy("u").agg(F.min("v").alias("root"))
    return nodes.join(roots, nodes.node == roots.u, "left").select("node", F.coalesce("root", "node").alias("root"))


def trimmed() -> None:
    """Gives back what earlier tasks of this worker process left unused: stages of a pipeline share workers."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every platform has it
        ctypes.CDLL(None).malloc_trim(0)
