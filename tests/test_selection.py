"""Exact percentiles, with groups far larger than what a task sorts."""

import math
import random

import pytest
from pyspark.sql import functions as F

from trawl.operators.selection import percentiles

PS = {"p1": 0.001, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}


def nearest(values, p):
    values = sorted(v for v in values if v is not None)
    return values[max(1, math.ceil(p * len(values))) - 1] if values else None


@pytest.mark.parametrize("kind", ["wide", "ties", "one value", "powers"])
def test_percentiles(spark, kind):
    r = random.Random(kind)
    value = {"wide": lambda: r.gauss(0, 1e6), "ties": lambda: float(r.choice([1, 1, 1, 2, 3])), "one value": lambda: 7.0, "powers": lambda: r.choice([-1, 1]) * 10.0 ** r.uniform(-300, 300)}[kind]
    rows = [(r.choice(["hot"] * 8 + ["cold", None]), None if r.random() < 0.05 else value(), r.randrange(1000)) for _ in range(3000)] + [("small", 1.0, 1), ("none", None, None)]
    df = spark.createDataFrame(rows, "g string, v double, n long").repartition(6)
    wanted = {f"v_{k}": ("v", p) for k, p in PS.items()} | {"n_p50": ("n", 0.5)}
    for bound in (20, 100_000):
        got = {x.g: tuple(x)[1:] for x in percentiles(df, ["g"], wanted, bound).collect()}
        assert got == {g: (*[nearest([x[1] for x in rows if x[0] == g], p) for p in PS.values()], nearest([x[2] for x in rows if x[0] == g], 0.5)) for g in ("hot", "cold", None, "small", "none")}, bound


def test_whole_table_and_empty(spark):
    df = spark.range(5000).select(F.col("id").alias("v"))
    assert [tuple(r) for r in percentiles(df, [], {"a": ("v", 0.5), "b": ("v", 0.999)}, 50).collect()] == [(2499, 4994)]
    assert percentiles(df.limit(0).withColumn("g", F.lit(1)), ["g"], {"a": ("v", 0.5)}).collect() == []
