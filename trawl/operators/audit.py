"""Audit logs: sequence and time checks, line checks, event windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sequence_issues(df: DataFrame, group: list[str], line: str = "line", seq: str = "seq") -> DataFrame:
    """group, line, seq, issue: seq_duplicate before seq_reorder before seq_gap; a group that doesn't begin with 1: seq_group_not_from_1."""
    w = Window.partitionBy(*group).orderBy(line)
    again = F.row_number().over(Window.partitionBy(*group, seq).orderBy(line)) > 1
    prev = F.lag(seq).over(w)
    x = df.select(*group, line, seq, F.row_number().over(w).alias("_no"), again.alias("_again"), prev.alias("_prev"))
    issue = F.when(F.col("_again"), "seq_duplicate").when(F.col(seq) < F.col("_prev"), "seq_reorder").when(F.col(seq) != F.col("_prev") + 1, "seq_gap")
    first = F.when((F.col("_no") == 1) & (F.col(seq) != 1), "seq_group_not_from_1")
    return x.select(*group, line, seq, F.explode(F.array_compact(F.array(first, issue))).alias("issue"))


def sequence_groups(df: DataFrame, group: list[str], line: str = "line", seq: str = "seq") -> DataFrame:
    no = F.row_number().over(Window.partitionBy(*group).orderBy(line))
    x = df.withColumn("_ok", F.col(seq) == no)
    return x.groupBy(*group).agg(F.count("*").alias("n"), F.min_by(seq, line).alias("seq_first"), F.max_by(seq, line).alias("seq_last"), F.min("_ok").alias("ok"))


def time_regressions(df: DataFrame, group: list[str], line: str, t: str, tolerance: float = 1.0) -> DataFrame:
    """Rows more than the tolerance below the highest time before them in their group."""
    high = F.max(t).over(Window.partitionBy(*group).orderBy(line).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("high", high).where(F.col(t) < F.col("high") - tolerance)


def in_windows(events: DataFrame, bounds: DataFrame, key: str, t: str, names: list[str], name: str, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Rows of bounds with n: events of these names within [lo, hi]; zero counts stay.

    An equality join on the key, the range as a further condition: each event meets only its own tenant's bounds."""
    e = events.where(F.col(name).isin(*names)).select(F.col(key), F.col(t).alias("_t"))
    got = bounds.join(e, (bounds[key] == e[key]) & e["_t"].between(bounds[lo], bounds[hi]), "left")
    return got.groupBy(*[bounds[c] for c in bounds.columns]).agg(F.count("_t").alias("n"))


def next_event(df: DataFrame, key: str, order: list[str], t: str, is_work: Column) -> DataFrame:
    """df with next_t: time of the next later row of the same key that is work. One sort, no join."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
    return df.withColumn("next_t", F.first(F.when(is_work, F.col(t)), ignorenulls=True).over(w))
