"""Benchmark decontamination: q-gram filtering in diagonal bands, then alignment near the bands that are left.

An item of m characters occurs in a text when a stretch of the text is within k = EDITS * m edits of it. By the q-gram
lemma such a stretch shares at least m - q + 1 - k * q of the item's q-grams, on diagonals (text position less item
position) that differ by k at most. Texts are scanned once: every position's q-gram is looked up in a bitmap of the
items' q-grams; stretches in which too few positions hit are left; the hits of the others are counted by item in
diagonal bands of width 2 * (k + 1), each overlapping half of the next: first in a hashed table, whose counts are too
high at most, then exactly; bands that reach the bound are verified by an alignment near the band.

Texts and items are taken as UTF-8 with A-Z in lower case and blanks squeezed; lengths and edits count bytes there. Items shorter than q + 1 bytes are
matched exactly, between characters that are neither letters nor digits. Items of fewer than BRIEF bytes have tables of their own, so that their low bounds don't let more of the
text through for the others. Null and empty texts, and null or blank items, match nothing. Repeated rows are judged alike. Ties between places of one item go to the first that was found; every item that
occurs is told. Very long texts are read whole. An empty table gives an empty result. find() reads key and text only, and clean() keeps all columns, so other columns' names can't clash.
Items are sent to the tasks in groups of at most GROUP bytes, so what is
broadcast and held is bounded however long the benchmark is. With more than one group, each reads the texts once and writes the ids and text hashes of those with a
hit; texts are never written.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import staged, trimmed

Q, EDITS, GROUP, BRIEF = 8, 0.1, 4 << 20, 64
_MIX, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_UP = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def plain(text: str | None) -> bytes:
    return b" ".join((text or "").encode("utf-8", "surrogatepass").translate(_UP).split())


def grams(b: bytes) -> np.ndarray:
    """The q-gram at each position as a 64-bit hash; what two grams' clash could add, the alignment takes away."""
    n = len(b) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    eight = np.ndarray((len(b) - 7,), "<u8", b, strides=(1,))
    return eight[:n] * _MIX + eight[Q - 8 :] * _MIX2


def budget(m: int) -> int:
    """Edits allowed for an item of m bytes: as EDITS says, but so few that one shared q-gram at least is required."""
    return max(0, min(int(m * EDITS), (m - Q) // Q))


class Group:
    """The items of one group: brief ones and others."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        parts = [r for r in rows if len(r[1]) < BRIEF], [r for r in rows if len(r[1]) >= BRIEF]
        self.parts = [Items(p) for p in parts if p]

    def found(self, text: bytes) -> list[tuple[int, int, int]]:
        return [x for p in self.parts for x in p.found(text)]


def _word(text: bytes, item: bytes) -> int:
    """Where the item first stands as words of its own, or -1."""
    m = re.search(rb"(?<![0-9a-z\x80-\xff])" + re.escape(item) + rb"(?![0-9a-z\x80-\xff])", text) if item in text else None
    return m.start() if m else -1


class Items:
    """Items, and the tables to look their q-grams up."""

    def __init__(self, rows: list[tuple[int, bytes]], bits: int = 22):
        self.rows = [(i, b) for i, b in rows if b]
        self.bits = np.uint64(64 - bits)
        keys, item, at = [], [], []
        for n, (_, b) in enumerate(self.rows):
            g = grams(b)
            keys.append(g)
            item.append(np.full(len(g), n, np.int64))
            at.append(np.arange(len(g)))
        keys, item, at = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((keys, np.uint64), (item, np.int64), (at, np.int64)))
        order = np.argsort(keys, kind="stable")
        self.keys, self.item, self.at = keys[order], item[order], at[order]
        #: where the entries begin whose keys have the same upper bits
        gaps = np.diff((self.keys >> self.bits).astype(np.int64), prepend=-1, append=1 << bits)
        self.first = np.repeat(np.arange(len(gaps), dtype=np.int32), gaps)
        self.hit = self.first[1:] > self.first[:-1]
        self.length = np.array([len(b) for _, b in self.rows], np.int64)
        self.edits = np.array([budget(len(b)) for _, b in self.rows], np.int64)
        self.half = self.edits + 1
        self.least = np.maximum(1, self.length - Q + 1 - self.edits * Q)
        self.short = [n for n, (_, b) in enumerate(self.rows) if len(b) <= Q]
        long_ = self.length > Q
        #: what any window must hold to be looked at
        self.window = int((self.length + self.edits)[long_].max(initial=0))
        self.floor = int(self.least[long_].min(initial=1 << 40))

    def found(self, text: bytes) -> list[tuple[int, int, int]]:
        """(item id, edits, start) of every item that occurs: its best place."""
        out = [(self.rows[n][0], 0, at) for n in self.short if (at := _word(text, self.rows[n][1])) >= 0]
        if len(text) < Q or not len(self.keys):
            return out
        g = grams(text)
        pos = np.flatnonzero(self.hit[g >> self.bits])
        if len(pos) < self.floor:
            return out
        # positions in some window with enough hits
        first = pos[: len(pos) - self.floor + 1]
        dense = pos[self.floor - 1 :] - first < self.window
        if not dense.any():
            return out
        near = np.zeros(len(pos) + 1, np.int64)
        near[: len(first)] += dense
        near[self.floor : self.floor + len(first)] -= dense
        pos = pos[np.cumsum(near[:-1]) > 0]
        top = g[pos] >> self.bits
        lo = self.first[top]
        n = self.first[top + np.uint64(1)] - lo
        at = np.repeat(pos, n)
        entry = np.arange(len(at)) + np.repeat(lo - np.cumsum(n) + n, n)
        item = self.item[entry]
        cell = (at - self.at[entry] + self.window) // self.half[item]  # above 0; a band is two cells
        # counts in a hashed table, which are too high at most: what is in no band with enough of them is left
        mask = (1 << max(12, int(len(at)).bit_length() + 1)) - 1
        slot = (item * 0x9E3779B1 + cell) & mask
        count = np.bincount(slot, minlength=mask + 1)
        mine, least = count[slot], self.least[item]
        live = np.flatnonzero((mine + np.maximum(count[(slot - 1) & mask], count[(slot + 1) & mask])) >= least)
        live = live[self.keys[entry[live]] == g[at[live]]]
        if not len(live):
            return out
        at, item, cell = at[live], item[live], cell[live]
        # one count for each text position, so that a repeated q-gram of the item doesn't count twice
        key = np.concatenate([np.stack([item, cell, at]), np.stack([item, cell - 1, at])], axis=1)
        key = np.unique(key, axis=1)
        change = np.flatnonzero(np.any(np.diff(key[:2], axis=1, prepend=-5), axis=0))
        counts = np.diff(np.append(change, key.shape[1]))
        best: dict[int, tuple[int, int]] = {}
        for i, b in ((int(key[0, c]), int(key[1, c])) for c, k in zip(change, counts, strict=True) if k >= self.least[key[0, c]]):
            if best.get(i, (1,))[0] == 0:
                continue
            width = int(self.edits[i]) + 1
            d, start = align(self.rows[i][1], text, b * width - self.window, 2 * width, int(self.edits[i]))
            if d <= self.edits[i] and d < best.get(i, (1 << 40,))[0]:
                best[i] = d, start
        return out + [(self.rows[i][0], d, s) for i, (d, s) in best.items()]


def align(item: bytes, text: bytes, diagonal: int, width: int, k: int) -> tuple[int, int]:
    """(least edits, where the band starts) between the item and any stretch of the text near diagonals diagonal .. + width - 1.

    An alignment that touches the band leaves it by k diagonals at most, so k more on each side are searched. Myers'
    bit vectors: a column of the edit table is two numbers of as many bits as the item has bytes."""
    m = len(item)
    full, high = (1 << m) - 1, 1 << (m - 1)
    same: dict[int, int] = {}
    for i, c in enumerate(item):
        same[c] = same.get(c, 0) | 1 << i
    up, down, score, best = full, 0, m, m
    for c in text[max(0, diagonal - k) : max(0, diagonal + width + k + m)]:
        eq = same.get(c, 0)
        x = ((((eq & up) + up) ^ up) | eq | down) & full
        more, less = down | (full & ~(x | up)), up & x
        if more & high:
            score += 1
        elif less & high:
            score -= 1
            if score < best:
                best = score
        more, less = (more << 1) & full, (less << 1) & full
        x = eq | down
        up, down = less | (full & ~(x | more)), more & x
    return best, max(0, diagonal)


def groups(benchmark: DataFrame, key: str = "item_id", text: str = "text"):
    """Groups of items of at most GROUP bytes; rows stream to the driver, one group is held at a time."""
    rows, size = [], 0
    for r in benchmark.select(key, text).where(F.col(text).isNotNull()).toLocalIterator():
        b = plain(r[1])
        if rows and size + len(b) > GROUP:
            yield rows
            rows, size = [], 0
        rows.append((r[0], b))
        size += len(b)
    if rows:
        yield rows


def _scan(docs: DataFrame, rows, texts: str, hits_only: bool) -> DataFrame:
    """docs (doc_id, text, and hash where hits_only) -> doc_id, hash or nothing, items, edits of one group of items."""
    sent = docs.sparkSession.sparkContext.broadcast(rows)
    at = docs.columns.index(texts)
    others = [i for i in range(len(docs.columns)) if i != at]
    names = [docs.columns[i] for i in others]

    def scan(batches):
        table = Group(sent.value)
        for batch in batches:
            found = []
            for t in batch.column(at).to_pylist():
                best: dict[int, int] = {}
                for i, d, _ in table.found(plain(t)):
                    best[i] = min(d, best.get(i, d))
                found.append(sorted(best.items()))
            out = pa.RecordBatch.from_arrays([*(batch.column(i) for i in others), pa.array([[i for i, _ in f] for f in found], pa.list_(pa.int64())), pa.array([[d for _, d in f] for f in found], pa.list_(pa.int32()))], [*names, "items", "edits"])
            yield out.filter(pa.array([bool(f) for f in found], pa.bool_())) if hits_only else out

    shape = ", ".join(f"{n} {docs.schema[n].dataType.simpleString()}" for n in names)
    return docs.mapInArrow(scan, f"{shape}, items array<long>, edits array<int>")


def _hits(docs: DataFrame, first, todo) -> DataFrame:
    """(doc_id, hash, items, edits) of the texts with hits, over all groups; each group's are written."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    parts, rows = [], first
    while rows is not None:
        parts.append(staged(_scan(keyed, rows, "text", True), "leaks"))
        rows = next(todo, None)
    all_ = reduce(DataFrame.unionByName, parts).dropDuplicates(["doc_id", "hash", "items"])  # equal rows have equal hits
    pair = all_.select("doc_id", "hash", F.explode(F.arrays_zip("items", "edits")).alias("x")).groupBy("doc_id", "hash", "x.items").agg(F.min("x.edits").alias("edits"))
    both = F.array_sort(F.collect_list(F.struct("items", "edits")))
    return pair.groupBy("doc_id", "hash").agg(both.alias("x")).select("doc_id", "hash", F.col("x.items").alias("items"), F.col("x.edits").alias("edits"))


def find(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_items, items (ids in order, each once), edits (of each, the least found)."""
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    todo = groups(benchmark, item_key, item_text)
    first, second = next(todo, []), next(todo, None)
    if second is None:
        out = _scan(docs, first, "text", False)
    else:
        hits = _hits(docs, first, chain([second], todo)).withColumnsRenamed({"doc_id": "_id", "hash": "_hash"})
        out = docs.select("doc_id", F.xxhash64("text").alias("hash"))
        out = out.join(hits, out.doc_id.eqNullSafe(hits["_id"]) & (out.hash == hits["_hash"]), "left")
        out = out.select("doc_id", F.coalesce("items", F.array().cast("array<long>")).alias("items"), F.coalesce("edits", F.array().cast("array<int>")).alias("edits"))
    return out.select("doc_id", F.size("items").alias("n_items"), "items", "edits")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of docs, with their columns, in whose text no item occurs."""
    todo = groups(benchmark)
    first, second = next(todo, []), next(todo, None)
    if second is not None:
        hits = _hits(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), first, chain([second], todo)).select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"))
        return docs.join(hits, docs[key].eqNullSafe(hits["_id"]) & (F.xxhash64(docs[text]) == hits["_hash"]), "left_anti")
    at = docs.columns.index(text)
    sent = docs.sparkSession.sparkContext.broadcast(first)

    def keep(batches):
        trimmed()
        table = Group(sent.value)
        for batch in batches:
            yield batch.filter(pa.array([not table.found(plain(t)) for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
