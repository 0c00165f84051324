"""Keyed ledgers: upserts, provenance, frontiers, unions, budgets, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in the given order. A minimum per key on the map side, no window over a hot key."""
    return _by_extreme(df, keys, order, F.min_by)


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    return _by_extreme(df, keys, order, F.max_by)


def _by_extreme(df, keys, order, pick):
    rest = [c for c in df.columns if c not in keys]
    out = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return out.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def sources_of(df: DataFrame, keys: Sequence[str], src: str, order: str) -> DataFrame:
    """One row per key: sources, the distinct src in order of first appearance. (key, src) pairs are reduced before they are gathered."""
    pairs = df.where(F.col(src).isNotNull()).groupBy(*keys, src).agg(F.min(order).alias("_at"))
    got = pairs.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("_at", src))), lambda x: x[src]).alias("sources"))
    return got


def frontier(candidates: DataFrame, key: str, order: str, *known: DataFrame) -> DataFrame:
    """Candidates, each key once (the first), that none of the known tables has."""
    out = first_wins(candidates, [key], [order])
    for k in known:
        out = out.join(k.select(key), key, "left_anti")
    return out


def union_first(key: Sequence[str], *ranked: DataFrame) -> DataFrame:
    """Union of ledgers; of each key the row of the earliest ledger stays. Ledgers have a column ord for order within."""
    all_ = None
    for i, df in enumerate(ranked):
        df = df.withColumn("_rank", F.lit(i))
        all_ = df if all_ is None else all_.unionByName(df)
    return first_wins(all_, key, ["_rank", "ord"]).drop("_rank")


def top_per(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int | Column) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
