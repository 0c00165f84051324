"""Exact n-gram Jaccard join: prefix keys of parts find families, signature trees join them.

1. Each text becomes its set of word shingles. Texts with equal sets are one class (by a 64-bit fingerprint of the set).
2. A set is cut into parts by its shingles' hashes. Sets that link differ in few shingles, so most parts of both are the same; of a part's order that its own
   contents give (those with several shingles that aren't frequent in a bounded sample first), the first d + 1 parts of each have one in common, where d is the most shingles that
   may differ. These are the join keys. A key stands for several shingles together, so texts that have only common phrases in common share none. Keys
   connect classes to families; linked classes are in one family.
3. Families are joined by signature trees: a node has the OR of its sets' token bitmaps, the range of their sizes, and the
   most tokens that one bitmap loses to clashes. Two trees are walked together; a pair of nodes is dropped when its bitmaps allow less overlap
   than its sizes require, or when all its sets are linked already. Pairs of sets that are left are compared exactly.
   Large families are cut into blocks by hash, and each pair of blocks is a task.
4. Only the links that connect something new are kept, so copies and near copies give a spanning forest, not all pairs; it has the
   same components.

Frequency, order, blocks and broadcasts (FREQUENT, SENT) change the work, never the result. Links and classes rest on 64-bit hashes of shingles: two different shingles
of one pair of texts clash with a chance of about n * n / 2**65. Null and empty texts have an empty set, link with nothing and are their own component. Rows with a
null id link with nothing and have a null component. Rows that share an id are separate rows. An empty table gives an empty result. Ties don't arise: links are a yes or no. Very long texts are read whole.
Only id and text are read, and one_of_each() keeps all columns, so other columns' names can't clash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm import shingles
from trawl.llm.common import bounded_fraction, components, released, share, staged

#: Words of a shingle; linked: part * union <= 100 * intersection.
WORDS, PART = 4, 85
SAMPLE, FREQUENT = 4_000, 50_000
#: Keys are looked at in so many slices, one after another.
SLICES = 4
BLOCK, BLOCK_BYTES, FAN = 1024, 16 << 20, 8
#: Representatives' ids are broadcast up to this many, joined otherwise.
SENT = 1_000_000


def need(n, part=PART):
    """Least overlap of a set of n with any set that it links with."""
    return -(-part * n // 100)


def differing(n, part=PART):
    """Most shingles that are in only one of a set of n and a set that it links with."""
    return (n + 100 * n // part) * (100 - part) // (100 + part)


def edges(part: int, most: int = 1 << 40) -> np.ndarray:
    """Sizes at which a band begins: sets that link are in the same band or in neighbouring ones."""
    out = [1]
    while out[-1] < most:
        out.append(out[-1] * 100 // part + 1)
    return np.array(out)


def parts_of(part: int = PART, tokens: frozenset[int] = frozenset()) -> list[int]:
    """For each g, into how many parts the sets of bands g - 1 and g are cut (a power of two, by the shingles' last bits), or 0: single shingles, as in those of tokens.

    There are enough for more filled parts than shingles may differ, by far: of two sets that link, some filled part is the same."""
    out = [0]
    for g, hi in enumerate((edges(part)[1:] - 1).tolist(), 1):
        p, least = 1, 1.15 * differing(hi, part) + 6
        while p < 2 * hi and p * -np.expm1(-hi / p) < least:
            p *= 2
        out.append(p if p < 2 * hi and g not in tokens else 0)
    return out


def keys_of(s: np.ndarray, frequent: np.ndarray, band: int, cuts: list[int], part: int = PART) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """The keys of a set: those of its first parts, and those among them that have nothing but frequent shingles; the g where it has too few filled parts.

    Of two sets that link, at most d = differing(n) parts differ, so that the first d + 1 filled parts of both, in an order that
    the parts' contents give, have one in common. First come the parts with the most shingles that aren't frequent, then the largest."""
    n, early, late, odd = len(s), [], [], []
    if not n:
        return s, s, odd
    at = np.searchsorted(frequent, s)
    rare = frequent[np.minimum(at, len(frequent) - 1)] != s if len(frequent) else np.ones(n, bool)
    for g in (band,) if cuts[band] == cuts[band + 1] > 0 else (band, band + 1):
        if p := cuts[g]:
            where = s & np.uint64(p - 1)
            order = np.argsort(where, kind="stable")
            where = where[order]
            begins = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
            some, r = np.add.reduceat(shingles.mixed(s[order] + np.uint64(p)), begins), np.minimum(np.add.reduceat(rare[order].astype(np.int64), begins), 3)
            size, k = np.minimum(np.diff(np.append(begins, n)), 3), differing(n, part) + 1
            if len(some) < k:
                odd.append(g)
        else:
            some, r, size, k = s ^ np.uint64(g << 32), rare.astype(np.int64), 1, n - need(n, part) + 1
        # 48 bits: two parts that clash are one more pair to compare
        some = shingles.mixed(some) >> np.uint64(16)
        first = np.lexsort((some, -(4 * r + size)))[:k]
        early.append(some[first[r[first] > 0]])
        late.append(some[first[r[first] == 0]])
    return np.concatenate(early), np.concatenate(late), odd


def _mark(s: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int((shingles.mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum() + np.uint64(len(s))).astype(np.int64))


def frequent_shingles(docs: DataFrame, n_rows: int, words: int = WORDS) -> np.ndarray:
    """Up to FREQUENT shingles that are in more than one of 200 texts of a sample of about SAMPLE."""
    sample = docs.where(share(F.col("doc_id"), bounded_fraction(max(1, n_rows), SAMPLE)))

    def cut(batches):
        for batch in batches:
            found = list(shingles.sets(batch.column(1).to_pylist(), words))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["s"])

    counts = sample.mapInArrow(cut, "s long").groupBy("s").count()
    least = max(10, min(n_rows, SAMPLE) // 200)
    rows = counts.where(F.col("count") > least).orderBy(F.desc("count"), "s").limit(FREQUENT).collect()
    return np.sort(np.array([r.s for r in rows], np.int64).view(np.uint64))


class Tree:
    """Signature tree over sets in the given order; level 0 has the sets."""

    def __init__(self, sets: list[np.ndarray], bits: int):
        words = bits // 64
        base = np.zeros((len(sets), words), np.uint64)
        for row, s in zip(base, sets, strict=True):
            at = (s & np.uint64(bits - 1)).astype(np.int64)
            np.bitwise_or.at(row, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        size = np.array([len(s) for s in sets], np.int64)
        self.levels = [(base, size, size, size - np.bitwise_count(base).sum(axis=1).astype(np.int64))]
        while len(self.levels[-1][0]) > FAN:
            b, lo, hi, lost = self.levels[-1]
            at = np.arange(0, len(b), FAN)
            self.levels.append((np.bitwise_or.reduceat(b, at, axis=0), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.maximum.reduceat(lost, at)))

    def children(self, level: int, node: int) -> range:
        return range(node * FAN, min(len(self.levels[level - 1][0]), node * FAN + FAN))


class Joined:
    """Which sets are linked so far: each one's root is at hand at any time."""

    def __init__(self, n: int):
        self.roots = np.arange(n)

    def link(self, i: int, j: int) -> None:
        self.roots[self.roots == self.roots[i]] = self.roots[j]


def _same(roots: np.ndarray, n: int, depth: int) -> list[np.ndarray]:
    """For each level, the root that all sets below a node have, or -1."""
    out = [roots]
    for _ in range(depth - 1):
        at = np.arange(0, len(out[-1]), FAN)
        lo, hi = np.minimum.reduceat(out[-1], at), np.maximum.reduceat(out[-1], at)
        out.append(np.where(lo == hi, lo, -1))
    return out


def tree_join(a: list[np.ndarray], b: list[np.ndarray] | None = None, part: int = PART) -> list[tuple[int, int]]:
    """Links that connect the sets of a (with b None) or of a with b: positions, b's being counted from 0. A spanning forest of all such links."""
    if not a or (b is not None and not b):
        return []
    bits = 1 << max(9, min(16, int(4 * max(map(len, a + (b or [])))).bit_length()))
    order = lambda x: sorted(range(len(x)), key=lambda i: (len(x[i]).bit_length(), int(x[i][0]) if len(x[i]) else 0, len(x[i])))
    oa = order(a)
    a = [a[i] for i in oa]
    left = Tree(a, bits)
    if b is None:
        ob, b, right, shift = oa, a, left, 0
    else:
        ob = order(b)
        b = [b[i] for i in ob]
        right, shift = Tree(b, bits), len(a)
    joined = Joined(len(a) + (len(b) if shift else 0))
    links: list[tuple[int, int]] = []

    def possible(la: int, lb: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        (ba, loa, hia, xa), (bb, lob, hib, xb) = left.levels[la], right.levels[lb]
        ok = (100 * hia[x] >= part * lob[y]) & (100 * hib[y] >= part * loa[x])
        out = np.zeros(len(x), bool)
        at = np.flatnonzero(ok)
        most = np.bitwise_count(ba[x[at]] & bb[y[at]]).sum(axis=1).astype(np.int64) + np.minimum(xa[x[at]], xb[y[at]])
        out[at] = (100 + part) * most >= part * (loa[x[at]] + lob[y[at]])
        return out

    def walk(la: int, lb: int, x: np.ndarray, y: np.ndarray) -> None:
        step = 512 if la == lb == 0 else 256
        for at in range(0, len(x), step):
            xs, ys = x[at : at + step], y[at : at + step]
            roots = joined.roots
            sa, sb = _same(roots[: len(a)], len(a), la + 1)[la], _same(roots[shift : shift + len(b)], len(b), lb + 1)[lb]
            keep = ~((sa[xs] == sb[ys]) & (sa[xs] >= 0))
            if b is a:
                keep &= (xs <= ys) if la == lb else True
            xs, ys = xs[keep], ys[keep]
            ok = possible(la, lb, xs, ys)
            xs, ys = xs[ok], ys[ok]
            if la == 0 and lb == 0:
                for i, j in zip(xs.tolist(), ys.tolist(), strict=True):
                    if (b is not a or i < j) and roots[i] != roots[shift + j]:
                        n = len(np.intersect1d(a[i], b[j], assume_unique=True))
                        if n and 100 * n >= part * (len(a[i]) + len(b[j]) - n):
                            joined.link(i, shift + j)
                            links.append((oa[i], ob[j]))
                continue
            # the children of all pairs that are left, many at a time
            down = lambda t, level, at: (at[:, None] * FAN + np.arange(FAN), len(t.levels[level - 1][0]))
            for a0 in range(0, len(xs), 32):
                i, j = xs[a0 : a0 + 32], ys[a0 : a0 + 32]
                ci, ni = down(left, la, i) if la >= lb else (i[:, None], len(left.levels[la][0]))
                cj, nj = down(right, lb, j) if lb >= la else (j[:, None], len(right.levels[lb][0]))
                ci, cj = np.broadcast_arrays(ci[:, :, None], cj[:, None, :])
                real = (ci < ni) & (cj < nj)
                walk(la - (la >= lb), lb - (lb >= la), ci[real], cj[real])

    ta, tb = len(left.levels) - 1, len(right.levels) - 1
    na, nb = len(left.levels[ta][0]), len(right.levels[tb][0])
    walk(ta, tb, np.repeat(np.arange(na), nb), np.tile(np.arange(nb), na))
    return links


def _join_blocks(pdf: pd.DataFrame, part: int) -> pd.DataFrame:
    pdf = pdf.sort_values("cid")
    first = pdf[pdf["side"] == 0]
    sets = [np.frombuffer(x, np.uint64) for x in first["set"]]
    ids = first["cid"].to_numpy()
    if (pdf["side"] == 1).any():
        second = pdf[pdf["side"] == 1]
        links = tree_join(sets, [np.frombuffer(x, np.uint64) for x in second["set"]], part)
        other = second["cid"].to_numpy()
    else:
        links, other = (tree_join(sets, None, part) if pdf["alone"].iloc[0] else []), ids
    return pd.DataFrame({"a": [ids[i] for i, _ in links], "b": [other[j] for _, j in links]}).astype("int64")


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*parts, np.zeros(0, np.uint64)]).view(np.int64)))


def classes(docs: DataFrame, words: int = WORDS, part: int = PART) -> DataFrame:
    """doc_id, text_hash, n, band (of sizes), cid (the class's fingerprint), keys and late (those that are frequent); one row per row of docs (doc_id, text), written once."""
    n_rows = docs.count()
    sent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, n_rows, words))
    shape = "doc_id long, text_hash long, n long, band int, cid long, keys array<long>, late array<long>, odd array<int>"
    tokens = frozenset()
    while True:

        def cut(batches, tokens=tokens):
            frequent, starts, cuts = sent.value, edges(part), parts_of(part, tokens)
            for batch in batches:
                n, band, cid, keys, late, odd = [], [], [], [], [], []
                for s in shingles.sets(batch.column(1).to_pylist(), words):
                    n.append(len(s))
                    band.append(int(np.searchsorted(starts, len(s), "right")))
                    cid.append(_mark(s))
                    early, rest, few = keys_of(s, frequent, band[-1], cuts, part)
                    keys.append(early)
                    late.append(rest)
                    odd.append(few)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(band, pa.int32()), pa.array(cid, pa.int64()), _lists(keys), _lists(late), pa.array(odd, pa.list_(pa.int32()))], ["doc_id", "text_hash", "n", "band", "cid", "keys", "late", "odd"])

        rows = staged(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(cut, shape), "classes")
        more = {r.g for r in rows.select(F.explode("odd").alias("g")).distinct().collect()}
        if not more:
            return rows
        # shingles that happen to lie in few parts: sets of these sizes have single shingles as keys
        tokens |= more
        released(rows)


def families(rows: DataFrame) -> DataFrame:
    """(cid, family) of the classes that may link with another one: those connected by keys.

    Keys that aren't frequent are few of a kind, so each kind is looked at in one place, a slice of them at a time; a frequent key's lowest class is summed up first."""
    base = rows.where("n > 0 AND doc_id IS NOT NULL")
    kind, pairs = Window.partitionBy("key"), []
    for i in range(SLICES):
        keys = base.select("cid", F.explode(F.filter("keys", lambda k: k % SLICES == i)).alias("key"))
        pairs.append(staged(keys.select(F.col("cid").alias("a"), F.min("cid").over(kind).alias("b")).where("a != b").distinct(), "pairs"))
    late = base.select("cid", F.explode("late").alias("key")).distinct()
    low = late.groupBy("key").agg(F.min("cid").alias("b"), F.max("cid").alias("c")).where("b != c").drop("c")
    pairs.append(staged(late.join(low, "key").select(F.col("cid").alias("a"), "b").where("a != b").distinct(), "pairs"))
    edges = pairs[0]
    for x in pairs[1:]:
        edges = edges.union(x)
    out = staged(components(edges.distinct()).select(F.col("node").alias("cid"), F.col("root").alias("family")), "families")
    released(*pairs)
    return out


def links(docs: DataFrame, rows: DataFrame, members: DataFrame, words: int = WORDS, part: int = PART) -> DataFrame:
    """(a, b): links between classes; with equal sets being one class, these connect all that is linked. members: (cid, family)."""
    first = rows.where("doc_id IS NOT NULL").join(members, "cid").groupBy("cid", "family", "band").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"))
    first = staged(first, "members")
    # blocks of each family's band, and of the bands beside it
    sizes = first.groupBy("family", "band").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") * 8 / BLOCK_BYTES)).cast("int").alias("blocks"))
    for name, step in (("below", 1), ("above", -1)):
        beside = sizes.select("family", (F.col("band") + step).alias("band"), F.col("blocks").alias(name))
        first = first.join(beside, ["family", "band"], "left").fillna(0, [name])
    first = first.join(sizes, ["family", "band"])
    first = F.broadcast(first) if members.count() <= SENT else first
    texts = docs.join(first, "doc_id").select("cid", "n", "family", "band", "blocks", "below", "above", "text")

    def cut(batches):
        for batch in batches:
            sets = list(shingles.sets(batch.column(7).to_pylist(), words))
            # another row may have the same id and another text
            good = pa.array([_mark(s) == c for s, c in zip(sets, batch.column(0).to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in (0, 2, 3, 4, 5, 6)), pa.array([s.tobytes() for s in sets], pa.binary())], ["cid", "family", "band", "blocks", "below", "above", "set"]).filter(good)

    sets = texts.mapInArrow(cut, "cid long, family long, band int, blocks int, below int, above int, set binary")
    sets = sets.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    # tasks: two blocks of one band, or a block of a band and one of the band above it
    own, up = F.sequence(F.lit(0), F.col("blocks") - 1), lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    block, band = F.col("block"), F.col("band")
    task = lambda band, across, i, j, side: F.struct(band.alias("band"), F.lit(across).alias("across"), i.alias("i"), j.alias("j"), side.cast("int").alias("side"))
    tasks = F.concat(
        F.transform(own, lambda o: task(band, False, F.least(block, o), F.greatest(block, o), block > o)),
        F.transform(up(F.col("above")), lambda o: task(band, True, block, o, F.lit(0))),
        F.transform(up(F.col("below")), lambda o: task(band - 1, True, o, block, F.lit(1))),
    )
    sets = sets.select("cid", "set", "family", F.explode(tasks).alias("t")).select("cid", "set", "family", "t.*").withColumn("alone", ~F.col("across") & (F.col("i") == F.col("j")))
    return sets.groupBy("family", "band", "across", "i", "j").applyInPandas(lambda pdf: _join_blocks(pdf.drop_duplicates("cid"), part), "a long, b long")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, part: int = PART) -> DataFrame:
    """One row per row of docs: doc_id, text_hash, n_shingles, component_id (smallest doc_id reachable by links), copies (rows with the same set)."""
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    keyed = classes(docs, words, part)
    members = families(keyed)
    rows = staged(keyed.drop("keys", "late", "odd"), "classes")
    released(keyed)  # the keys take the most room
    roots = staged(components(links(docs, rows, members, words, part)), "linked").select(F.col("node").alias("cid"), "root")
    same = rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("cid").agg(F.min("doc_id").alias("lowest"), F.count("*").alias("copies"))
    low = same.join(roots, "cid").groupBy("root").agg(F.min("lowest").alias("component"))
    of = same.join(roots.join(low, "root").select("cid", "component"), "cid", "left").select("cid", F.coalesce("component", "lowest").alias("component"), "copies")
    out = rows.select("doc_id", "text_hash", "n", "cid").join(of, "cid", "left")
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    return out.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"), F.when(alone, 1).otherwise(F.col("copies")).cast("long").alias("copies"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, part: int = 80) -> DataFrame:
    """docs, with their columns, but of each group of linked rows only the one with the smallest id; rows without an id stay.

    What goes is a list of ids and text hashes: broadcast up to SENT rows, joined otherwise."""
    judged = staged(join(docs, key, text, words, part).where("doc_id IS NOT NULL"), "groups").withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    gone = judged.where("_id <> component_id").select("_id", "_hash").distinct()
    # a row that occurs several times, id and all, is kept once
    twice = judged.where("_id = component_id AND n_shingles > 0").groupBy("_id", "_hash").count().where("count > 1").select("_id", "_hash")
    hint = F.broadcast if judged.where("_id <> component_id").count() <= SENT else lambda x: x
    same = lambda other: (docs[key] == other["_id"]) & F.xxhash64(docs[text]).eqNullSafe(other["_hash"])
    kept = docs.join(hint(gone), same(gone), "left_anti")
    if twice.limit(1).count():
        kept = kept.join(twice, same(twice), "left_anti").unionByName(docs.join(twice, same(twice), "left_semi").dropDuplicates([key, text]))
    return kept
