"""Ranked lexical search of items over whole documents, exact, by presence masks.

Score of a document for an item: the sum over the item's terms, repeats included, of w * ((10**9 * tf) div (1000 * tf + 8 * m)),
with w = floor(1000 * ln((2N + 2) / (2df + 1))) and m = 25 + (75 * n * N) div L, where N documents have a term, L terms in all,
and the document has n.

Method. Postings of the items' terms are written once, by document. A task takes a block of documents. For each item, the
presence bitmaps of its terms over the block, turned by 90 degrees, are each document's mask of matched terms; documents are grouped by mask.
A mask's maximum is the sum of its terms' highest weights in the block. Masks are evaluated by falling
maximum, and the item is done with the block as soon as the next maximum is below the K-th score that the task has found so far; equal
maxima are still evaluated, as ties go by document id.

Sizes: a task keeps K rows an item and hands on no more. Items' terms are held by tasks, VOCABULARY of them and BAG rows at most; more
items are searched in further passes over the texts, each with its share of items by hash. A block has BLOCK postings at most, or is one document.

Defined results: null and empty texts have no term, so no row; null document ids take part and come first among equal
scores; repeated ids are documents of their own, so that an id may have several ranks; rows with one item id are one item with the
terms of all of them; an item without terms, or whose terms no document has, gives no row; empty tables give none. Very long texts are read whole, in pieces.
Only key and text columns are read, so other columns' names can't clash."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import staged

#: Items' distinct terms, and their rows, that one pass holds.
VOCABULARY, BAG = 2_000_000, 4_000_000
#: Postings that a block has at most.
BLOCK = 2_000_000
#: Documents in a block at most: what a presence matrix has as columns.
WIDE = 16_384
#: Bytes of a text that are cut into terms at a time.
PIECE = 1 << 20
#: Documents scored at a time at first, or one mask's; doubled from step to step.
STEP = 64
SALTS = 256

_SPLIT = bytes(c if c >= 0x80 or chr(c).isdigit() or chr(c).islower() else ord(chr(c).lower()) if chr(c).isupper() else 32 for c in range(256))


def terms(text: bytes | None):
    """The terms of a text in UTF-8, as lists for pieces of it: runs of letters and digits and all that isn't ASCII; only A-Z lower-cased."""
    flat, at = (text or b"").translate(_SPLIT), 0
    while at < len(flat):
        end = at + PIECE
        end = len(flat) if end >= len(flat) else flat.find(b" ", end)
        end = len(flat) if end < 0 else end
        yield flat[at:end].split()
        at = end


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _bags(items: DataFrame, item: str, text: str) -> DataFrame:
    """item, term, times."""

    def cut(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                found = Counter(w for piece in terms(batch.column(1)[at].as_py()) for w in piece)
                same = batch.column(0).slice(at, 1).take(pa.array([0] * len(found), pa.int64()))
                yield pa.RecordBatch.from_arrays([same, pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["item", "term", "times"])

    rows = items.select(F.col(item).alias("item"), F.col(text).cast("binary")).mapInArrow(cut, f"item {items.schema[item].dataType.simpleString()}, term binary, times long")
    return staged(rows.groupBy("item", "term").agg(F.sum("times").alias("times")), "bags")


def _postings(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """doc, n (terms of the text, repeats included), at (numbers of its terms in the vocabulary), tf; texts without terms are left out."""

    def cut(batches):
        get = vocabulary.get
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                keep, sizes, ats, tfs = [], [], [], []
                for i, raw in enumerate(part.column(1)):
                    n, found = 0, Counter()
                    for piece in terms(raw.as_py()):
                        n += len(piece)
                        found.update(map(get, piece))
                    if n:
                        found.pop(None, None)
                        keep.append(i)
                        sizes.append(n)
                        ats.append(np.fromiter(found.keys(), np.int32, len(found)))
                        tfs.append(np.fromiter(found.values(), np.int64, len(found)))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(keep, pa.int64())), pa.array(sizes, pa.int64()), pa.array(ats, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))], ["doc", "n", "at", "tf"])

    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("binary")).mapInArrow(cut, "doc long, n long, at array<int>, tf array<long>")
    return staged(rows, "postings")


class Block:
    """Postings of some documents by term, with their weights."""

    def __init__(self, docs: np.ndarray, norms: np.ndarray, doc: np.ndarray, at: np.ndarray, tf: np.ndarray):
        self.docs = docs
        order = np.argsort(at, kind="stable")
        self.doc, tf = doc[order], tf[order]
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 8 * norms[self.doc])
        self.terms, self.starts = np.unique(at[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(at))
        self.most = np.maximum.reduceat(self.impact, self.starts) if len(at) else self.impact

    def best(self, at: np.ndarray, weights: np.ndarray, k: int, so_far: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], int]:
        """The k best (-score, doc) of so_far and this block for an item's terms, and how many documents were scored."""
        where = np.searchsorted(self.terms, at)
        here = np.flatnonzero(where < len(self.terms))
        here = here[self.terms[where[here]] == at[here]]
        where, weights = where[here], weights[here]
        limit = -so_far[-1][0] if len(so_far) == k else 1
        if not len(here) or int(weights @ self.most[where]) < limit:
            return so_far, 0
        present = np.zeros((len(here), len(self.docs)), bool)
        for row, w in zip(present, where, strict=True):
            row[self.doc[self.starts[w] : self.ends[w]]] = True
        some = np.flatnonzero(present.any(axis=0))
        first, group = _masks(present[:, some])
        maxima = (weights * self.most[where]) @ present[:, some[first]].astype(np.int64)
        by_mask = np.argsort(-maxima, kind="stable")
        rank = np.empty(len(first), np.int64)
        rank[by_mask] = np.arange(len(first))
        # documents in order of their masks' maxima, and where each mask's end
        order = np.argsort(rank[group], kind="stable")
        docs, ends = some[order], np.cumsum(np.bincount(rank[group], minlength=len(first)))
        maxima = maxima[by_mask]
        done, step, scored = 0, STEP, 0
        while done < len(first) and maxima[done] >= limit:
            # the next mask, with those behind it that may matter as far as there are no more than so many documents
            start = int(ends[done - 1]) if done else 0
            upto = max(done + 1, min(int(np.searchsorted(ends, start + step, "right")), int(np.searchsorted(-maxima, -limit, "right"))))
            d = docs[start : ends[upto - 1]]
            score = self._scores(d, where, weights)
            scored += len(d)
            found = d[score >= limit]
            so_far = sorted(so_far + list(zip((-score[score >= limit]).tolist(), self.docs[found].tolist(), strict=True)))[:k]
            limit = -so_far[-1][0] if len(so_far) == k else 1
            done, step = upto, step * 2
        return so_far, scored

    def _scores(self, d: np.ndarray, where: np.ndarray, weights: np.ndarray) -> np.ndarray:
        slot = np.full(len(self.docs), -1)
        slot[d] = np.arange(len(d))
        out = np.zeros(len(d), np.int64)
        for w, x in zip(where, weights, strict=True):
            to = slot[self.doc[self.starts[w] : self.ends[w]]]
            ok = to >= 0
            out[to[ok]] += x * self.impact[self.starts[w] : self.ends[w]][ok]
        return out


def _masks(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For columns of a presence matrix: one column of each distinct mask, and each column's mask number."""
    bits = np.packbits(present, axis=0)
    words = np.zeros((-(-len(bits) // 8) * 8, bits.shape[1]), np.uint8)
    words[: len(bits)] = bits
    number = np.zeros(bits.shape[1], np.int64)
    first = np.zeros(min(1, len(number)), np.int64)
    for at in range(0, len(words), 8):
        word = np.ascontiguousarray(words[at : at + 8].T).view(np.uint64).ravel()
        _, word = np.unique(word, return_inverse=True)
        _, first, number = np.unique(number * (word.max(initial=0) + 1) + word, return_index=True, return_inverse=True)
    return first, number


def _blocks(batch: pa.RecordBatch, n_docs: int, n_terms: int):
    """Blocks of a batch of postings."""
    ids = np.array(batch.column(0).fill_null(_NULL))
    m = np.array([25 + 75 * n * n_docs // n_terms for n in batch.column(1).to_pylist()], np.int64)
    ends = np.asarray(batch.column(2).offsets).astype(np.int64)
    at, tf = np.asarray(batch.column(2).values), np.asarray(batch.column(3).values)
    lo = 0
    while lo < len(ids):
        hi = max(lo + 1, min(lo + WIDE, int(np.searchsorted(ends, ends[lo] + BLOCK, "right")) - 1))
        span = slice(ends[lo], ends[hi])
        yield Block(ids[lo:hi], m[lo:hi], np.repeat(np.arange(hi - lo), np.diff(ends[lo : hi + 1])), at[span], tf[span])
        lo = hi


_NULL = -(1 << 63)  # stands for a null id


def search(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Each item's k best documents with a score above 0: item_id, rank (from 1), doc_id, score, by falling score and rising id."""
    bags = _bags(items, item, item_text)
    distinct, rows = bags.agg(F.count_distinct("term"), F.count("*")).first()
    passes = max(1, -(-distinct // VOCABULARY), -(-rows // BAG))
    found = [_pass(docs, bags.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == i), k, key, text) for i in range(passes)]
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out.select(F.col("item").alias(item), F.col("rank"), F.col("doc").cast(docs.schema[key].dataType).alias(key), "score")


def _pass(docs: DataFrame, bags: DataFrame, k: int, key: str, text: str) -> DataFrame:
    # bounded by VOCABULARY: search() counts the terms first
    vocabulary = {t: i for i, t in enumerate(sorted(r[0] for r in bags.select("term").distinct().toLocalIterator()))}
    postings = _postings(docs, vocabulary, key, text)
    n_docs, n_terms = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = postings.select(F.explode("at").alias("at")).groupBy("at").agg(F.count("*").alias("df"))
    weights = np.zeros(len(vocabulary), np.int64)
    for at, c in df.toLocalIterator():
        weights[at] = weight(n_docs, c)
    # bounded by BAG
    by_item: dict = {}
    for r in bags.toLocalIterator():
        by_item.setdefault(r[0], []).append((vocabulary[bytes(r[1])], r[2]))
    names, queries = list(by_item), []
    for name in names:
        at, times = np.array(sorted(by_item[name]), np.int64).reshape(-1, 2).T
        w = weights[at] * times
        queries.append((at[w > 0], w[w > 0]))

    def look(batches):
        best = [[] for _ in queries]
        for batch in batches:
            for block in _blocks(batch, n_docs, n_terms):
                for q, (at, w) in enumerate(queries):
                    best[q] = block.best(at, w, k, best[q])[0]
        part = TaskContext.get().partitionId()
        rows = [(q, None if d == _NULL else d, -s) for q, b in enumerate(best) for s, d in b]
        at, doc, score = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([part % SALTS] * len(rows), pa.int32()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], ["q", "salt", "doc", "score"])

    found = postings.mapInArrow(look, "q int, salt int, doc long, score long")
    order = [F.col("score").desc(), F.col("doc").asc_nulls_first()]
    for by in (["q", "salt"], ["q"]):  # tasks hand on k rows an item; first by salt, so that no task takes an item's rows from all tasks
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
    item_type = bags.schema["item"].dataType.simpleString()
    named = bags.sparkSession.createDataFrame(list(enumerate(names)), f"q int, item {item_type}")
    return found.join(named, "q").select("item", "rank", "doc", "score")
