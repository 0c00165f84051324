"""Rates, latencies, streaks and windows over request samples; all by tenant keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.operators.order import AT, PART, dealt, scan
from trawl.operators.selection import percentiles


def nearest_rank(c: str | Column, p: float) -> Column:
    """Exact nearest-rank percentile: the value of rank ceil(p * n)."""
    return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {c})")


def summary(df: DataFrame, by: list[str], c: str) -> DataFrame:
    """n, p50, p95, p99, mean and max of each group; percentiles by selection, so that a group may have any share of all rows."""
    plain = df.groupBy(*by).agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.max(c).alias("max"))
    ranks = percentiles(df, by, {f"p{p}": (c, p / 100) for p in (50, 95, 99)})
    on = reduce(lambda x, y: x & y, [plain[k].eqNullSafe(ranks[k]) for k in by])
    return plain.join(ranks, on).select(*[plain[k] for k in by], "n", "p50", "p95", "p99", "mean", "max")


def active_window(df: DataFrame, key: str, t: str, bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Per run: first and last sample, n, span, and what the run's bounds (key, start, end) leave before and behind: startup and tail, 0 at least, null where a bound is."""
    x = df.groupBy(key).agg(F.min(t).alias("first_t"), F.max(t).alias("last_t"), F.count(t).alias("n")).join(bounds.select(key, F.col(start).alias("_start"), F.col(end).alias("_end")), key, "left")
    left = lambda a, b: F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.greatest(F.col(a) - F.col(b), F.lit(0)))
    return x.select(key, "first_t", "last_t", "n", (F.col("last_t") - F.col("first_t")).alias("span"), left("first_t", "_start").alias("startup"), left("_end", "last_t").alias("tail"))


def streaks(df: DataFrame, key: str, order: list[str], ok: str) -> DataFrame:
    """df with streak: length so far of the run of equal ok values. Scans over range partitions: a run may be longer than any task's share."""
    x = dealt(df, [key], [F.col(o) for o in order])
    x = scan(x, [key], lags={"_prev": F.col(ok)}, sums={"_row": F.lit(1)})
    x = scan(x, [key], lasts={"_start": F.when((F.col("_row") == 1) | ~F.col(ok).eqNullSafe(F.col("_prev")), F.col("_row"))})
    return x.withColumn("streak", F.col("_row") - F.col("_start") + 1).drop("_prev", "_row", "_start", PART, AT)


def trailing_rate(df: DataFrame, key: str, t: str, bad: Column, seconds: int) -> DataFrame:
    """df with n_window and bad_window: rows, and bad rows, of the last so many seconds."""
    w = Window.partitionBy(key).orderBy(t).rangeBetween(-seconds, 0)
    return df.withColumn("n_window", F.count("*").over(w)).withColumn("bad_window", F.sum(bad.cast("int")).over(w))


def count_window(df: DataFrame, key: str, order: list[str], bad: Column, *sizes: int) -> DataFrame:
    for n in sizes:
        df = df.withColumn(f"bad_{n}", F.sum(bad.cast("int")).over(Window.partitionBy(key).orderBy(*order).rowsBetween(1 - n, 0)))
    return df


def most_in_window(df: DataFrame, key: str, t: str, seconds: int) -> DataFrame:
    """Per key: most events in any half-open stretch of so many seconds (whole-second times)."""
    w = Window.partitionBy(key).orderBy(t).rangeBetween(0, seconds - 1)
    return df.withColumn("n", F.count("*").over(w)).groupBy(key).agg(F.max("n").alias("most"))
