"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, distance-weighted votes.

Fit, on a sample of about SAMPLE labelled texts of each class (a documented bound; rows chosen by hash of their id): all words of
the examples are the index's words, each with the inverse of its document frequency over the whole corpus. That is multiplied
by the word's relevance, which grows from FLOOR to 1 with how surely its share differs between the classes: no word is left out, but
plain TF-IDF finds neighbours by subject, not by tone. The index has postings (example, weight) by word. Examples stand in blocks of
BLOCK that share words; for each word and block there is the largest weight, so a text's product with these bounds its cosine with
every example of a block. The FIRST blocks by bound are scored exactly from their postings, then all blocks whose bound reaches the K-th best score so far: the K
nearest are exact. The vote is the share of label 1 among them, weighted by the squared cosine. A monotone table, fitted on the examples'
own leave-one-out votes with weights that undo the sampling of classes, turns votes into calibrated scores; the neighbours are the evidence.

Null texts count as empty. Texts without any word of the index have the score that such examples have. Rows whose label is null aren't learned from;
a text labelled twice counts as its highest label. Ties among neighbours go to the smaller example id. Without two classes to learn from, every score is the share of label 1 (0 without any).
Very long texts are read whole. An empty table gives an empty result; repeated rows are judged alike. Only key and text of docs are read, so other columns' names can't clash.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import bounded_fraction, share, staged

SAMPLE, BLOCK, FIRST, K = 600, 64, 2, 16
#: Relevance of a word that tells nothing, and the z-score at which it is about one half.
FLOOR, HALF = 0.02, 6.0
_BLANK = bytes(c if c > 127 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_BLANK).split()


def relevance(d0: np.ndarray, d1: np.ndarray, n0: int, n1: int) -> np.ndarray:
    """FLOOR to 1 + FLOOR by the z-score of the difference between the shares d0 / n0 and d1 / n1."""
    p = (d0 + d1 + 1) / (n0 + n1 + 2)
    z2 = (d1 / n1 - d0 / n0) ** 2 / (p * (1 - p) * (1 / n0 + 1 / n1))
    return FLOOR + z2 / (z2 + HALF**2)


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All positions of the ranges start .. start + n - 1, one range after the other."""
    return np.arange(int(n.sum())) + np.repeat(start - np.cumsum(n) + n, n)


def _slices(column: np.ndarray, start: list[int], end: list[int]) -> np.ndarray:
    return np.concatenate([column[a:b] for a, b in zip(start, end, strict=True)])


class Index:
    def __init__(self, terms: list[bytes], weight: np.ndarray, examples: list[tuple[int, int, dict[bytes, int]]], class_sizes: tuple[int, int]):
        """weight: of each term; examples: (id, label, how often each word occurs)."""
        self.terms, self.weight = {t: i for i, t in enumerate(terms)}, np.asarray(weight, np.float64)
        n = [max(1, sum(e[1] == c for e in examples)) for c in (0, 1)]
        per = np.array([class_sizes[0] / n[0], class_sizes[1] / n[1]])
        self.base = self.blank = class_sizes[1] / max(1, sum(class_sizes))
        vectors = [self.vector(e[2]) for e in examples]
        empty = np.array([e[1] for e, v in zip(examples, vectors, strict=True) if not len(v[0])], np.int64)
        if len(empty):
            w = per[empty]
            self.blank = float((w * empty).sum() + 0.5 * self.base) / float(w.sum() + 0.5)
        # examples that share their strongest word stand together
        rows = [(int(v[0][v[1].argmax()]), -float(v[1].max()), e[0], i) for i, (e, v) in enumerate(zip(examples, vectors, strict=True)) if len(v[0])]
        order = [r[3] for r in sorted(rows)]
        self.ids, self.y = np.array([examples[i][0] for i in order], np.int64), np.array([examples[i][1] for i in order], np.int64)
        vectors = [vectors[i] for i in order]
        word = np.concatenate([v[0] for v in vectors] or [np.zeros(0, np.int64)])
        example = np.repeat(np.arange(len(vectors)), [len(v[0]) for v in vectors])
        by = np.argsort(word, kind="stable")
        word, self.example, self.value = word[by], example[by].astype(np.int32), np.concatenate([v[1] for v in vectors] or [np.zeros(0)])[by]
        # for each word and block: where its postings begin, and the largest (a little above, for its rounding)
        self.blocks = -(-len(vectors) // BLOCK)
        cell = word * self.blocks + self.example // BLOCK
        self.start = np.searchsorted(cell, np.arange(len(terms) * self.blocks + 1)).astype(np.int32)
        self.most = np.zeros(len(terms) * self.blocks, np.float32)
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        self.most[cell[first]] = np.maximum.reduceat(self.value, first) * 1.000001 if len(first) else 0
        self.most = self.most.reshape(len(terms), self.blocks)
        self.at, self.level = np.array([0.0]), np.array([self.base])
        if len(vectors):
            vote = np.array([self.vote(*self.nearest(*v, own=i)) for v, i in zip(vectors, self.ids, strict=True)])
            self.at, self.level = _monotone(vote, self.y, per[self.y])

    def vector(self, counts: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """Terms, and weights of unit length: (1 + ln tf) * weight."""
        get = self.terms.get
        ids, n = np.array([get(w, -1) for w in counts], np.int64), np.array(list(counts.values()), np.float64)
        known = ids >= 0
        ids = ids[known]
        w = (1 + np.log(n[known])) * self.weight[ids]
        size = np.sqrt((w * w).sum())
        return (ids, w / size) if size else (ids[:0], w[:0])

    def nearest(self, terms: np.ndarray, weights: np.ndarray, own: int | None = None, k: int = K) -> tuple[np.ndarray, np.ndarray]:
        """(cosines, example rows) of the k nearest, nearest first; fewer where fewer share a word. own: an id to leave out."""
        score = np.zeros(len(self.ids))
        bound = weights @ self.most[terms]
        left = bound > 0

        def evaluate(some: np.ndarray) -> None:
            """Adds the scores of some blocks' examples, from the postings of these blocks alone."""
            at = (terms[:, None] * self.blocks + some).ravel()
            n = self.start[at + 1] - self.start[at]
            posting = _ranges(self.start[at], n)
            score[:] += np.bincount(self.example[posting], np.repeat(np.repeat(weights, len(some)), n) * self.value[posting], minlength=len(score))

        first = np.argsort(-bound, kind="stable")[:FIRST]
        evaluate(first[left[first]])
        out = self.ids == own if own is not None else np.zeros(len(score), bool)
        best = np.sort(score[~out])[-k:]
        left[first] = False
        rest = np.flatnonzero(left & (bound >= (best[0] if len(best) == k else 0) - 1e-6))
        if len(rest) > self.blocks // 4:  # the lists are read from end to end, which costs less than many pieces
            a, b = self.start[terms * self.blocks], self.start[(terms + 1) * self.blocks]
            w, (a, b) = np.repeat(weights, b - a), (a.tolist(), b.tolist())
            score = np.bincount(_slices(self.example, a, b), w * _slices(self.value, a, b), minlength=len(score))
        elif len(rest):
            evaluate(rest)
        score = np.round(score, 6)
        score[out] = 0
        row = np.flatnonzero(score > 0)
        if len(row) > k:
            row = row[score[row] >= np.partition(score[row], -k)[-k]]
        row = row[np.lexsort([self.ids[row], -score[row]])[:k]]
        return score[row], row

    def vote(self, cosine: np.ndarray, row: np.ndarray) -> float:
        w = cosine**2
        return float((w * self.y[row]).sum() / w.sum()) if len(row) else 0.0

    def judge(self, text: str | None) -> tuple[float, list[int]]:
        """The score, and the ids of the examples that voted."""
        v = self.vector(Counter(words(text)))
        if not len(v[0]) or not len(self.ids):
            return float(np.clip(self.blank, 0, 1)), []
        cosine, row = self.nearest(*v)
        return float(np.clip(np.interp(self.vote(cosine, row), self.at, self.level), 0, 1)), self.ids[row].tolist()


def _monotone(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling neighbours: the points of a growing table."""
    pools: list[list[float]] = []
    for i in np.argsort(x, kind="stable"):
        pools.append([x[i] * w[i], y[i] * w[i], w[i]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def document_frequencies(docs: DataFrame, terms: list[bytes], text: str = "text") -> np.ndarray:
    """In how many of all rows of docs each term occurs; each task sends one sum for each term."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches):
        at = {t: i for i, t in enumerate(sent.value)}
        seen = np.zeros(len(at), np.int64)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                found = [i for i in map(at.get, set(words(t))) if i is not None]
                seen[found] += 1
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some])], ["i", "n"])

    rows = docs.select(text).mapInArrow(count, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(terms), np.int64)
    out[[r.i for r in rows]] = [r.n for r in rows]
    return out


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Index:
    """An index from the texts of docs that labels (key, label) marks."""
    marks = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max(label).cast("int").alias("y"))
    sizes = {r.y: r["count"] for r in marks.groupBy("y").count().collect()}
    sizes = (sizes.get(0, 0), sizes.get(1, 0))
    chosen = F.lit(False)
    for c in (0, 1):
        chosen = chosen | ((F.col("y") == c) & share(F.col("id"), bounded_fraction(max(1, sizes[c]), SAMPLE)))
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    # the sample's size is bounded by SAMPLE
    sample = texts.join(F.broadcast(marks.where(chosen)), "id")

    def cut(batches):
        for batch in batches:
            w = [sorted(Counter(words(t)).items()) for t in batch.column(2).to_pylist()]
            w = [[{"w": x, "n": n} for x, n in one] for one in w]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(w, pa.list_(pa.struct([("w", pa.binary()), ("n", pa.int32())])))], ["id", "y", "w"])

    bags = staged(sample.select(F.col("id").cast("long"), "y", "text").mapInArrow(cut, "id long, y int, w array<struct<w:binary,n:int>>"), "bags")
    # the examples are a bounded sample, and the terms are theirs
    examples = [(r.id, r.y, {bytes(x.w): x.n for x in r.w}) for r in bags.orderBy("id", F.xxhash64("w")).collect()]
    n0, n1 = (sum(e[1] == c for e in examples) for c in (0, 1))
    if not n0 or not n1:
        return Index([], np.zeros(0), [], sizes)
    in_class = [Counter(w for e in examples if e[1] == c for w in e[2]) for c in (0, 1)]
    terms = sorted(set(in_class[0]) | set(in_class[1]))
    d0, d1 = (np.array([c[t] for t in terms], np.float64) for c in in_class)
    idf = np.log((docs.count() + 1) / (document_frequencies(texts, terms) + 1)) + 1
    return Index(terms, idf * relevance(d0, d1, n0, n1), examples, sizes)


def score(docs: DataFrame, index: Index, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, score, neighbours (ids of the examples that voted)."""
    sent = docs.sparkSession.sparkContext.broadcast(index)
    kind = docs.schema[key].dataType.simpleString()

    def judge(batches):
        index = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [index.judge(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s for s, _ in found], pa.float64()), pa.array([i for _, i in found], pa.list_(pa.int64()))], ["doc_id", "score", "neighbours"])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(judge, f"doc_id {kind}, score double, neighbours array<long>")
