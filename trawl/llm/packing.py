"""Packing: length buckets with the least padding, and token-budget batches inside each.

A document's length is a given column, such as the number of tokens by tokens.lengths(), which op8 and the pipeline
give; without one it is the number of words (runs of characters other than blanks), and the budget is one of words.
The histogram of lengths over all rows goes to the driver. Up to EXACT each length is a bin of its own; longer ones share bins whose width is
1/64 of their length or less, so that the histogram's size is bounded. A bin has its number of rows, their exact sum and their greatest length. Dynamic programming over
the bins finds the bucket boundaries whose total padding is least: the least of all where no length is above EXACT, else of all boundaries between bins;
every boundary is the length of a document. A batch of a bucket
holds as many documents as fit the token budget at the bucket's length, one at least. batched() gathers each batch's documents and token ids in one row.

Numbering inside a bucket needs no task that holds a bucket: rows are cut into cells by hash, about CELL rows each;
cells are counted, the counts are summed up in stretches of cells and then over stretches, and rows are numbered inside their cell.

Null texts and lengths count as 0. Ties: rows of one length are told apart by hash and id alone. Repeated rows are packed as often as they occur; where very many rows have one id and one length (or
no id), they are spread over cells by their place in the table, which is all the same as they are alike. An empty table gives no row. Very long texts are rows like others. Only the id,
the length and the columns to keep are read, so other columns' names can't clash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import staged

EXACT, CELL, STRETCH = 65_536, 256, 4_096


def binned(length):
    """The bin of a length: itself up to EXACT, above that rounded up so that few values are left."""
    step = F.pow(F.lit(2), F.floor(F.log2(F.greatest(length, F.lit(1)))) - 6).cast("long")
    return F.when(length <= EXACT, length).otherwise(F.ceil(length / step) * step).cast("long")


def boundaries(lengths: list[int], counts: list[int], buckets: int, sums: list[int] | None = None) -> list[int]:
    """Upper bounds of at most so many buckets, with the least total padding (sum of bound - length).

    lengths: of each bin, the greatest; sums: of each bin's lengths, where they aren't all equal. Dynamic programming over the bins; the best last cut moves right as the length grows (the cost is a
    Monge array), so each layer is found by divide and conquer."""
    order = np.argsort(lengths)
    v, c = np.asarray(lengths, np.int64)[order], np.asarray(counts, np.int64)[order]
    total = c * v if sums is None else np.asarray(sums, np.int64)[order]
    n = len(v)
    if not n:
        return []
    rows, mass = np.concatenate([[0], np.cumsum(c)]), np.concatenate([[0], np.cumsum(total)])
    cost = lambda i, j: v[j - 1] * (rows[j] - rows[i]) - (mass[j] - mass[i])  # noqa: E731  one bucket over lengths i..j-1
    best = np.array([0, *cost(np.zeros(n, np.int64), np.arange(1, n + 1))])
    cuts = []
    for _ in range(1, min(buckets, n)):
        now, cut = best.copy(), np.zeros(n + 1, np.int64)
        todo = [(1, n, 0, n - 1)]
        while todo:
            a, b, lo, hi = todo.pop()
            if a > b:
                continue
            j = (a + b) // 2
            i = np.arange(lo, min(hi, j - 1) + 1)
            total = best[i] + cost(i, j)
            k = int(np.argmin(total))
            now[j], cut[j] = total[k], i[k]
            todo += [(a, j - 1, lo, int(i[k])), (j + 1, b, int(i[k]), hi)]
        best = now
        cuts.append(cut)
    out, j = [], n
    for cut in reversed(cuts):
        if j <= 0:
            break
        out.append(int(v[j - 1]))
        j = int(cut[j])
    if j > 0:
        out.append(int(v[j - 1]))
    return sorted(set(out))


def words(text):
    """Number of runs of characters other than ASCII blanks."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def pack(docs: DataFrame, buckets: int = 16, budget: int = 65_536, key: str = "doc_id", length=None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, n_tokens, bucket (from 0, short to long), bucket_len, batch (within the bucket), slot, batch_docs (capacity), and the columns to keep."""
    length = words(F.col("text")) if length is None else length
    d = docs.select(F.col(key).alias("doc_id"), F.coalesce(length.cast("long"), F.lit(0)).alias("n_tokens"), F.struct(*keep).alias("kept") if keep else F.lit(None).cast("int").alias("kept"))
    # written once: else each condition below would count the words again
    d = staged(d.withColumn("place", F.monotonically_increasing_id()), "lengths")
    seen = d.groupBy(binned(F.col("n_tokens"))).agg(F.max("n_tokens").alias("most"), F.count("*").alias("n"), F.sum("n_tokens").alias("total")).collect()  # bounded: see binned()
    bounds = boundaries([r.most for r in seen], [r.n for r in seen], buckets, [r.total for r in seen])
    # counts by bucket, for the number of cells
    of = np.searchsorted(bounds, [r.most for r in seen])
    sizes = np.bincount(of, weights=[r.n for r in seen], minlength=len(bounds)) if seen else []
    bucket, cells, top = F.lit(None).cast("int"), F.lit(1), F.lit(None).cast("long")
    for i in range(len(bounds) - 1, -1, -1):
        inside = F.col("n_tokens") <= bounds[i]
        bucket, cells = F.when(inside, i).otherwise(bucket), F.when(inside, max(1, int(sizes[i]) // CELL)).otherwise(cells)
        top = F.when(F.col("bucket") == i, F.lit(bounds[i]).cast("long")).otherwise(top)
    # rows of one id and length are spread by their place, in steps that leave few of them together
    often = d.groupBy("doc_id", "n_tokens").count().where(F.col("count") > CELL).select(F.col("doc_id").alias("_id"), F.col("n_tokens").alias("_n"))
    if often.limit(1).count():
        d = d.join(often, d.doc_id.eqNullSafe(often["_id"]) & (d.n_tokens == often["_n"]), "left").withColumn("place", F.when(F.col("_n").isNotNull(), F.col("place")))
    else:
        d = d.withColumn("place", F.lit(None).cast("long"))
    d = d.select("doc_id", "n_tokens", "kept", bucket.cast("int").alias("bucket"), F.pmod(F.xxhash64("doc_id", "place"), cells.cast("long")).alias("cell"))
    count = d.groupBy("bucket", "cell").count().withColumn("stretch", F.floor(F.col("cell") / STRETCH))
    running = lambda c, by, at: F.coalesce(F.sum(c).over(Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    long_ = count.groupBy("bucket", "stretch").agg(F.sum("count").alias("total"))
    long_ = long_.select("bucket", "stretch", running("total", ["bucket"], "stretch").alias("start"))
    count = count.withColumn("inner", running("count", ["bucket", "stretch"], "cell")).join(long_, ["bucket", "stretch"]).select("bucket", "cell", (F.col("start") + F.col("inner")).alias("before"))
    d = d.withColumn("inside", F.row_number().over(Window.partitionBy("bucket", "cell").orderBy("doc_id", "n_tokens")) - 1)
    d = d.join(count, ["bucket", "cell"]).withColumn("bucket_len", top)
    d = d.withColumn("batch_docs", F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("bucket_len"), F.lit(1)))).cast("long"))
    at = F.col("before") + F.col("inside")
    return d.select("doc_id", "n_tokens", "bucket", "bucket_len", F.floor(at / F.col("batch_docs")).alias("batch"), (at % F.col("batch_docs")).alias("slot"), "batch_docs", *[F.col("kept")[k].alias(k) for k in keep])


def batched(packed: DataFrame, ids: str) -> DataFrame:
    """One row per batch: bucket, batch, bucket_len, and its documents in order of their slots, each padded to bucket_len with zeros. packed must keep ids, arrays of token ids; a batch is of the budget's size or one document."""
    row = F.struct("slot", "doc_id", F.concat(ids, F.array_repeat(F.lit(0), (F.col("bucket_len") - F.size(ids)).cast("int"))).alias("ids"))
    return packed.groupBy("bucket", "batch", "bucket_len").agg(F.array_sort(F.collect_list(row)).alias("docs"))
