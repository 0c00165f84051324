"""Order at scale: ranks, running values and neighbours of rows by group, without gathering a group in one task.

Rows are dealt by range of (group, order), so that a group with any share of all rows lies in as many partitions as its
size asks for. Each partition's rows are numbered where they lie; what a partition must know of those before it is one small
row for each group it holds (a carry), and the carries of a group are as many as partitions at most."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.streaming.shared import written

PART, AT = "_part", "_at"


def dealt(df: DataFrame, group: list[str], order: list[Column], partitions: int | None = None) -> DataFrame:
    """df by range of (group, order), written to the shared folder and read again, with _part and _at, which orders all rows.

    Rows that are equal in group and order keep to one partition and may lie in any order: let order end with what
    tells rows apart. Nulls come first in groups; order says for itself."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(g).asc_nulls_first() for g in group] + list(order)
    x = df.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn(AT, F.monotonically_increasing_id())
    # the upper bits of such an id are its partition's number
    return written(x, "ordered").withColumn(PART, F.shiftright(AT, 33))


def _with_carries(rows: DataFrame, carries: DataFrame, group: list[str], names: list[str]) -> DataFrame:
    """rows with the columns of their (part, group)'s carry. Each such key has one partition's rows at most."""
    c = carries.select(*[F.col(k).alias(f"_c_{k}") for k in (PART, *group)], *names)
    on = reduce(lambda x, y: x & y, [rows[k].eqNullSafe(c[f"_c_{k}"]) for k in (PART, *group)])
    return rows.join(c, on).drop(*[f"_c_{k}" for k in (PART, *group)])


def numbered(rows: DataFrame, group: list[str], rank: str = "rn", size: str | None = None) -> DataFrame:
    """Dealt rows with their number within the group, from 1, and the group's size if named. No row is shuffled again where the carries are small."""
    starts = rows.groupBy(PART, *group).agg(F.min(AT).alias("_start"), F.count("*").alias("_n"))
    w = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("_n").over(w.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    carries = starts.select(PART, *group, (before - F.col("_start") + 1).alias("_shift"), F.sum("_n").over(w).alias("_size"))
    out = _with_carries(rows, carries, group, ["_shift", "_size"]).withColumn(rank, F.col(AT) + F.col("_shift"))
    return (out.withColumn(size, F.col("_size")) if size else out).drop("_shift", "_size")


def ranked(df: DataFrame, group: list[str], order: list[Column], rank: str = "rn", size: str | None = None, partitions: int | None = None) -> DataFrame:
    """df with each row's number in its group by order, from 1: row_number() whose groups aren't gathered in one task."""
    return numbered(dealt(df, group, order, partitions), group, rank, size).drop(PART, AT)


def scan(rows: DataFrame, group: list[str], sums: dict[str, Column] | None = None, maxima: dict[str, Column] | None = None, lags: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None) -> DataFrame:
    """Dealt rows with running values of their group, each under its name:

    sums: the total up to and with the row (nulls count as 0); maxima: the largest value up to and with the row;
    lags: the value of the row before (null for the first one); lasts: the last value that isn't null, up to and with the row.

    Two passes: within (part, group), and over the carries. Further scans of the result share its partitioning."""
    sums, maxima, lags, lasts = sums or {}, maxima or {}, lags or {}, lasts or {}
    values = {**sums, **maxima, **lags, **lasts}
    rows = rows.select("*", *[c.alias(f"_v_{n}") for n, c in values.items()])
    v = {n: F.col(f"_v_{n}") for n in values}
    here = Window.partitionBy(PART, *group).orderBy(AT)
    upto = here.rowsBetween(Window.unboundedPreceding, 0)

    ends = [F.sum(v[n]).alias(f"_e_{n}") for n in sums] + [F.max(v[n]).alias(f"_e_{n}") for n in maxima]
    # in structs, as max_by of a null value must not look like no value
    ends += [F.max_by(F.struct(v[n].alias("v")), AT).alias(f"_e_{n}") for n in lags]
    ends += [F.max_by(v[n], F.when(v[n].isNotNull(), F.col(AT))).alias(f"_e_{n}") for n in lasts]
    across = (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    e = {n: F.col(f"_e_{n}") for n in values}
    carry = [F.coalesce(F.sum(e[n]).over(across), F.lit(0)).alias(f"_c_{n}") for n in sums] + [F.max(e[n]).over(across).alias(f"_c_{n}") for n in maxima]
    carry += [F.last(e[n], ignorenulls=True).over(across).alias(f"_c_{n}") for n in (*lags, *lasts)]
    carries = rows.groupBy(PART, *group).agg(*ends).select(PART, *group, *carry)

    local = [F.coalesce(F.sum(v[n]).over(upto), F.lit(0)).alias(f"_l_{n}") for n in sums] + [F.max(v[n]).over(upto).alias(f"_l_{n}") for n in maxima]
    local += [F.lag(F.struct(v[n].alias("v"))).over(here).alias(f"_l_{n}") for n in lags] + [F.last(v[n], ignorenulls=True).over(upto).alias(f"_l_{n}") for n in lasts]
    x = _with_carries(rows.select("*", *local), carries, group, [f"_c_{n}" for n in values])
    both = {n: (F.col(f"_l_{n}"), F.col(f"_c_{n}")) for n in values}
    out = {n: both[n][0] + both[n][1] for n in sums} | {n: F.greatest(*both[n]) for n in maxima}
    out |= {n: F.coalesce(*both[n])["v"] for n in lags} | {n: F.coalesce(*both[n]) for n in lasts}
    keep = [c for c in rows.columns if not c.startswith("_v_") and c not in out]
    return x.select(*keep, *[c.alias(n) for n, c in out.items()])
