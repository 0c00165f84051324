"""Exact percentiles of groups of any size: selection by narrowing brackets.

A group's quantile grid (a mergeable sketch of bounded size) puts a wanted rank between two values of the grid. The rows below, at and
between these are counted: the rank is at one of the two values, or strictly on one side of them, nearly always between, where a few
rows in a hundred are. These are written, and the search goes on among them with the rank that is left, until at most BOUND rows of a
group remain, which are sorted. Each step leaves out its two values, so ties don't hold it up. Sketches, counts and BOUND rows are all that
a task holds of a group: no group is sorted or gathered whole. The sketch decides how fast the search ends, never what it finds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.streaming.shared import written

#: Values of a group that one task sorts.
BOUND = 65_536
#: Steps of the grid, and how many of them a bracket reaches to each side.
GRID, REACH = 256, 2


def percentiles(df: DataFrame, by: list[str], wanted: dict[str, tuple[str, float]], bound: int = BOUND) -> DataFrame:
    """One row per group: the columns of by, and each wanted name's nearest-rank percentile (column, p); null where a group has no value.

    Nulls are left out; groups may be null. Columns of different types are compared as doubles."""
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    types = {df.schema[c].dataType for c in columns}
    as_one = types.pop().simpleString() if len(types) == 1 else "double"
    at = [*by, "_at"]
    rows = df.select(*by, F.inline(F.array(*[F.struct(F.lit(c).alias("_at"), F.col(c).cast(as_one).alias("_v")) for c in columns]))).where("_v IS NOT NULL")
    counts = rows.groupBy(*at).agg(F.count("*").alias("_n"))
    of = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(name).alias("name"), F.lit(p).alias("p")) for name, (c, p) in wanted.items()])
    state = counts.select(*at, "_n", F.inline(of)).where("column = _at").select(*at, "name", F.greatest(F.ceil(F.col("p") * F.col("_n")), F.lit(1)).cast("long").alias("_rank"))

    found = []
    while True:
        here = rows.groupBy(*at).agg(F.count("*").alias("_n"), F.percentile_approx("_v", [i / GRID for i in range(GRID + 1)], 10_000).alias("_grid"))
        state = written(_join(state, here, at), "ranks")
        small = state.where(f"_n <= {bound}")
        lists = _join(rows, small.select(*at).distinct(), at).groupBy(*at).agg(F.sort_array(F.collect_list("_v")).alias("_all"))
        found.append(_join(small.select(*at, "name", "_rank"), lists, at).select(*by, "name", F.get("_all", (F.col("_rank") - 1).cast("int")).alias("_v")))
        large = state.where(f"_n > {bound}")
        if large.isEmpty():
            break
        step = F.floor(F.col("_rank") * GRID / F.col("_n")).cast("int")
        edge = lambda i: F.get("_grid", F.least(F.greatest(i, F.lit(0)), F.lit(GRID)))
        large = large.select(*at, "name", "_rank", edge(step - REACH).alias("_lo"), edge(step + REACH).alias("_hi"))
        v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
        met = _join(rows, large, at).groupBy(*by, "name").agg(*[F.count_if(c).alias(n) for n, c in {"_less": v < lo, "_low": v == lo, "_mid": (v > lo) & (v < hi), "_high": (v == hi) & (hi > lo)}.items()])
        x = _join(large, met, [*by, "name"])
        rank, upto = F.col("_rank"), [F.col("_less"), F.col("_less") + F.col("_low"), F.col("_less") + F.col("_low") + F.col("_mid"), F.col("_less") + F.col("_low") + F.col("_mid") + F.col("_high")]
        side = F.when(rank <= upto[0], "less").when(rank <= upto[1], "low").when(rank <= upto[2], "mid").when(rank <= upto[3], "high").otherwise("more")
        x = written(x.withColumn("_side", side).withColumn("_left", rank - F.when(F.col("_side") == "less", 0).when(F.col("_side") == "mid", upto[1]).otherwise(upto[3])), "sides")
        found.append(x.where("_side IN ('low', 'high')").select(*by, "name", F.when(F.col("_side") == "low", lo).otherwise(hi).alias("_v")))
        x = x.where("_side NOT IN ('low', 'high')")
        inside = F.when(F.col("_side") == "less", v < lo).when(F.col("_side") == "mid", (v > lo) & (v < hi)).otherwise(v > hi)
        # from now on a name has rows of its own
        rows = written(_join(rows, x.select(*at, "name", "_side", "_lo", "_hi"), at).where(inside).select(*by, F.col("name").alias("_at"), "_v"), "inside")
        state = x.select(*by, F.col("name").alias("_at"), "name", F.col("_left").alias("_rank"))

    all_found = reduce(DataFrame.unionByName, found).groupBy(*by).agg(*[F.max(F.when(F.col("name") == name, F.col("_v"))).cast(df.schema[c].dataType).alias(name) for name, (c, _) in wanted.items()])
    if not by:
        return all_found
    return _join(df.select(*by).distinct(), all_found, by, "left").select(*by, *wanted)


def _join(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """a with b's other columns; null keys meet null keys."""
    b = b.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in b.columns if c not in keys and c not in a.columns])
    return a.join(b, reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"_k_{k}"]) for k in keys]), how).drop(*[f"_k_{k}" for k in keys])
