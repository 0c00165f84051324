"""Writers: append with a key check, replace, CSV, versioned snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from trawl.streaming.shared import scratch

BUCKET = "_bucket"


#: Folders of a keyed sink. A batch reads those that its own keys fall into.
BUCKETS = 64


def bucket_of(keys: list[str], buckets: int = BUCKETS):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _with_bucket(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(BUCKET, IntegerType())])


def in_buckets(spark: SparkSession, path: str, schema: StructType, buckets: list[int]) -> DataFrame:
    """Rows of a keyed sink in some of its buckets; the folders of the others aren't read, nor are columns that aren't asked for."""
    if not exists(spark, path):
        return spark.createDataFrame([], _with_bucket(schema))
    return spark.read.schema(_with_bucket(schema)).parquet(path).where(F.col(BUCKET).isin(buckets))


def touched(df: DataFrame) -> list[int]:
    """The buckets that rows of df fall into: numbers below BUCKETS."""
    return sorted(r[0] for r in df.select(BUCKET).distinct().collect())


def into_buckets(df: DataFrame, path: str) -> None:
    """Appends rows to their buckets, one file for each bucket."""
    df.repartition(BUCKET).write.mode("append").partitionBy(BUCKET).parquet(path)


def append_new(df: DataFrame, path: str, keys: list[str]) -> None:
    """Appends rows whose key the sink doesn't have; safe to run again. Null keys are keys.

    Rows lie in folders by the key's hash. A batch reads the keys of its own folders only, so that what a small batch reads is a small part of the sink; compact() keeps
    the number of files down."""
    spark, schema = df.sparkSession, df.schema
    df = df.dropDuplicates(keys).withColumn(BUCKET, bucket_of(keys))
    if exists(spark, path):
        old = in_buckets(spark, path, schema, touched(df)).select(BUCKET, *[F.col(k).alias(f"_k_{k}") for k in keys])
        df = df.join(old, reduce(lambda x, y: x & y, [df[k].eqNullSafe(old[f"_k_{k}"]) for k in keys], df[BUCKET] == old[BUCKET]), "left_anti")
    into_buckets(df, path)


def compact(spark: SparkSession, path: str, schema: StructType, files: int = 16) -> list[int]:
    """Rewrites the buckets that have more files than that as one file each, and returns them. The rows are written aside before they replace the old files; no other writer may be at work."""
    at = F.input_file_name()
    many = spark.read.schema(_with_bucket(schema)).parquet(path).groupBy(BUCKET, at.alias("file")).count().groupBy(BUCKET).count().where(F.col("count") > files)
    many = touched(many)
    if many:
        aside = scratch(spark, "compact")
        into_buckets(in_buckets(spark, path, schema, many), aside)
        replace(spark.read.schema(_with_bucket(schema)).parquet(aside).repartition(BUCKET), path, BUCKET)
    return many


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def replace(df: DataFrame, path: str, *partitions: str) -> None:
    """All or nothing: the committer moves files when all tasks are done; with partitions, only those that df has are replaced."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if partitions else "static")
    (w.partitionBy(*partitions) if partitions else w).parquet(path)


def report_csv(df: DataFrame, path: str, sources: str = "sources", evidence: str = "evidence") -> None:
    """CSV with the first five sources joined by ; and evidence cut to 300 characters."""
    df = df.withColumn(sources, F.concat_ws(";", F.slice(sources, 1, 5))).withColumn(evidence, F.substring(evidence, 1, 300))
    df.write.mode("overwrite").option("header", "true").option("escape", '"').option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)


def snapshots(df: DataFrame, path: str, by: str = "site_id") -> None:
    """ver, sha, captured_at, text by site; rows of a site are brought together first, so that each site's folder gets few files."""
    df.repartition(by).write.mode("append").partitionBy(by).parquet(path)
