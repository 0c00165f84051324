"""Order statistics of sliding windows, and latency against a baseline that is frozen while it is bad.

Rows are numbered in their class at range partitions, and cut into blocks of consecutive numbers; a block also gets the rows before it that its
first windows reach back to. So a class of any size is many bounded groups. Within a block the windows are sorted lists that take
one value in and let one go at each row."""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.operators.order import AT, PART, dealt, numbered, scan

#: Rows of a block: what windows reach back to is a small part of it.
BLOCK = 8192
# Windows, quantiles and ratios of the latency rule.
RECENT, HISTORY, P_RECENT, P_BASE, LEAST, LOCK, RISE, GROW = 30, 256, 0.50, 0.10, 30, 1.5, 1.8, 0.5


class Window:
    """The last so many values, in order of size."""

    def __init__(self, size: int):
        self.size, self.values, self.sorted = size, [], []

    def push(self, v: float) -> None:
        self.values.append(v)
        insort(self.sorted, v)
        if len(self.values) > self.size:
            # values beyond the window are dropped from the front once in a while
            del self.sorted[bisect_left(self.sorted, self.values[-self.size - 1])]
            if len(self.values) > 16 * self.size:
                del self.values[: -self.size]

    def quantile(self, q: float) -> float:
        n = len(self.sorted)
        return self.sorted[min(n - 1, int(n * q))]


def quantiles(df: DataFrame, key: str, order: list[str], value: str, windows: dict[str, tuple[int, float]], block: int = BLOCK, partitions: int | None = None) -> DataFrame:
    """df, dealt (with _part and _at), with rn, and for each name (size, q): the value of rank min(n - 1, int(n * q)), from 0, among the last size rows of the key. Values are numbers that aren't null."""
    rows = numbered(dealt(df, [key], [F.col(o) for o in order], partitions), [key])
    reach = max(size for size, _ in windows.values()) - 1
    at = F.expr(f"(rn - 1) div {block}")
    # a block's last rows go to the next one too, as what came before; where windows are longer than blocks, to more
    last = F.expr(f"(rn - 1 + {reach}) div {block}")
    spread = rows.withColumn("_block", F.explode(F.sequence(at, last)))
    fields = [f for f in rows.schema.fields]
    names = list(windows)

    def slide(t: pa.Table) -> pa.Table:
        t = t.sort_by("rn")
        first = t.column("_block")[0].as_py() * block
        kept = {n: Window(size) for n, (size, _) in windows.items()}
        out, own = {n: [] for n in names}, []
        for i, (rn, v) in enumerate(zip(t.column("rn").to_pylist(), t.column(value).to_pylist(), strict=True)):
            for w in kept.values():
                w.push(v)
            if rn > first:
                own.append(i)
                for n in names:
                    out[n].append(kept[n].quantile(windows[n][1]))
        t = t.take(pa.array(own, pa.int64()))
        return pa.table([*[t.column(f.name) for f in fields], *[pa.array(out[n], t.schema.field(value).type) for n in names]], [*[f.name for f in fields], *names])

    schema = rows.schema
    for n in names:
        schema = schema.add(n, df.schema[value].dataType)
    return spread.groupBy(key, "_block").applyInArrow(slide, schema)


def latency_rise(ok: DataFrame, key: str, order: list[str], value: str, block: int = BLOCK, partitions: int | None = None) -> DataFrame:
    """ok (samples of requests that went well) with p50 of the last RECENT, cand (p10 of the last HISTORY), base, ratio and rise.

    base is cand, but while p50 is LOCK times cand or more it keeps the last value that it had before: a lasting slowdown doesn't become what is
    normal. rise is 0 below RISE, and counts from there, GROW at most. Fewer than LEAST samples have no ratio and don't lock."""
    x = quantiles(ok, key, order, value, {"p50": (RECENT, P_RECENT), "cand": (HISTORY, P_BASE)}, block, partitions)
    enough = F.least(F.col("rn"), F.lit(RECENT)) >= LEAST
    locked = enough & (F.col("cand") > 0) & (F.col("p50") != 0) & (F.col("p50") >= LOCK * F.col("cand"))
    x = scan(x, [key], lasts={"_free": F.when(~locked, F.col("cand"))})
    x = x.withColumn("base", F.coalesce("_free", "cand"))
    x = x.withColumn("ratio", F.when(enough & (F.col("base") > 0), F.col("p50") / F.col("base")))
    rise = F.when(F.col("ratio") >= RISE, F.least(F.lit(1.0 + GROW), F.col("ratio") / RISE) - 1.0).otherwise(0.0)
    return x.withColumn("rise", rise).drop("_free", PART, AT, "rn")
