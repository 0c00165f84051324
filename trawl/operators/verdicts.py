"""A store of verdicts on keyed rows, by classifier version: only what has no verdict yet goes to the caller's function.

The store is a keyed sink: a call reads the buckets of its own keys only. Each asked row leaves one line, verdict or failure; a failure is asked
again by later calls until it has been tried often enough. The function sees batches of prompts, inside tasks; where a batch fails, its
prompts are tried one by one, so that one bad prompt costs no other's verdict. What was said is written before anything reads it: nobody is asked twice."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from trawl.functions.text import json_in
from trawl.operators.ledger import first_wins
from trawl.sources import sinks

ASKED = "version string, said string, error string"


def _store(leads: DataFrame, keys: list[str]) -> StructType:
    return StructType([leads.schema[k] for k in keys] + [StructField(n, StringType()) for n in ("version", "said", "error")] + [StructField("ok", BooleanType())])


def standing(lines: DataFrame, keys: list[str], version: str) -> DataFrame:
    """One row per key: ok, said (of the verdict), error (of a failure) and tries."""
    lines = lines.where(F.col("version") == version)
    return lines.groupBy(*keys).agg(F.max("ok").alias("ok"), F.max(F.when(F.col("ok"), F.col("said"))).alias("said"), F.max(F.when(~F.col("ok"), F.col("error"))).alias("error"), F.count("*").alias("tries"))


def pending(leads: DataFrame, path: str, keys: list[str], version: str, tries: int = 3) -> DataFrame:
    """Rows of leads whose key has no verdict of this version and hasn't failed so often."""
    leads = leads.withColumn(sinks.BUCKET, sinks.bucket_of(keys))
    lines = sinks.in_buckets(leads.sparkSession, path, _store(leads, keys), sinks.touched(leads))
    done = standing(lines, keys, version).where(F.col("ok") | (F.col("tries") >= tries)).select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    return leads.join(done, reduce(lambda x, y: x & y, [leads[k].eqNullSafe(done[f"_k_{k}"]) for k in keys]), "left_anti").drop(sinks.BUCKET)


def classify_new(leads: DataFrame, path: str, ask: Callable[[list[str]], list[str]], prompt: Column, verdict: str, version: str, keys: list[str], order: list[Column], budget: int | None = None, batch: int = 32, tries: int = 3) -> None:
    """Asks for the keys of leads that are pending, each once by its first row in order, and appends what came to the store.

    verdict: the DDL of the JSON that is looked for in what was said; none found is a failure. budget: at most so many keys, the first in order."""
    first = first_wins(leads, keys, [F.struct(*order)])
    todo = pending(first, path, keys, version, tries)
    if budget is not None:
        todo = todo.orderBy(*order).limit(budget)
    todo = todo.select(*keys, prompt.alias("prompt"))
    schema = StructType([*[f for f in todo.schema.fields if f.name != "prompt"], *[StructField(n, StringType()) for n in ("said", "error")]])

    def one_by_one(prompts: list[str]) -> list[tuple[str | None, str | None]]:
        try:
            said = ask(prompts)
            if len(said) != len(prompts):
                raise ValueError("not one answer for each prompt")
            return [(s, None) for s in said]
        except Exception as e:
            if len(prompts) == 1:
                return [(None, f"{type(e).__name__}: {e}"[:200])]
            return [one_by_one([p])[0] for p in prompts]

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, batch):
                part = b.slice(at, batch)
                got = one_by_one(part.column("prompt").to_pylist())
                said, error = zip(*got, strict=True)
                yield pa.RecordBatch.from_arrays([*[part.column(k) for k in keys], pa.array(said, pa.string()), pa.array(error, pa.string())], [*keys, "said", "error"])

    said = todo.mapInArrow(run, schema)
    found = json_in(F.col("said"), verdict).isNotNull()
    said = said.select(*keys, F.lit(version).alias("version"), "said", F.when(F.col("error").isNotNull(), F.col("error")).when(~found, "no verdict in the answer").alias("error"))
    sinks.into_buckets(said.withColumn("ok", F.col("error").isNull()).withColumn(sinks.BUCKET, sinks.bucket_of(keys)), path)


def verdicts(spark: SparkSession, path: str, leads: DataFrame, keys: list[str], verdict: str, version: str) -> DataFrame:
    """One row per key of the store: ok, verdict, error (the last failure's) and tries."""
    lines = spark.read.schema(_store(leads, keys)).parquet(path).select(*keys, "version", "said", "error", "ok")
    return standing(lines, keys, version).select(*keys, "ok", json_in(F.col("said"), verdict).alias("verdict"), "error", "tries")
