"""Merkle manifest of a table: a digest per row, a tree per group, a tree of the groups, and a proof for every row.

Method: time-forward processing. Nodes have labels that put children before parents. A node sends its digest to its
parent through a priority queue ordered by label; the sweep takes the least label, which by then has all its children's
digests. The queue is external: between stretches of ARITY ** HEIGHT leaves it is Spark's sorted shuffle, whose messages are keyed
by the label of the node they are for and may lie on disk; within a stretch it is a heap, which holds at most
ARITY messages for each level. The reversed sweep goes from the root down and delivers to each node the
proof suffix of its parent, to which the node adds its own siblings.

Ranks of rows within their group come from range partitions (trawl.operators.order), so that a group with any share of
all rows is spread; a task holds one stretch at a time, at whatever size of the table. Digests are counted in levels
of stretches: log(rows) / log(ARITY ** HEIGHT) rounds.

Defined results: null values count as "-"; a null group is a group of its own and comes first; null keys come first in
their group; rows with one key are ordered by their digests; rows that are equal in all fields have equal digests and as many leaves. Empty
and very long texts are hashed as they are, in the JVM. An empty table gives no rows. Columns that aren't fields are
not read, so their names can't clash."""

from __future__ import annotations

import heapq
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import staged
from trawl.operators.order import ranked

ARITY = 8
#: Levels of a stretch: ARITY ** HEIGHT leaves are one task's unit.
HEIGHT = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*values: Column) -> Column:
    """The leaf of a row as 32 bytes: sha256 of its values, each '-' if null, else its UTF-8 byte count, ':' and itself."""
    text = [v.cast("string") for v in values]
    return F.unhex(F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text]), 256))


def h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def levels(n: int) -> int:
    """Levels above n nodes until one remains."""
    out = 0
    while n > 1:
        n, out = -(-n // ARITY), out + 1
    return out


def forward(leaves: list[str], up: int) -> list[list[str]]:
    """The nodes over leaves, level by level, for so many levels: a sweep by labels (last leaf below, level)."""
    nodes: list[list[str]] = [leaves] + [[] for _ in range(up)]
    queue: list[tuple[int, int, int, str]] = []
    last = len(leaves) - 1

    def send(level: int, index: int, d: str) -> None:
        """To the parent of node index of a level; equal labels keep the order of their children."""
        if level < up:
            parent = index // ARITY
            heapq.heappush(queue, (min((parent + 1) * ARITY ** (level + 1) - 1, last), level + 1, index, d))

    for i, leaf in enumerate(leaves):
        send(0, i, leaf)
        while queue and queue[0][0] == i:
            end, level, index, d = heapq.heappop(queue)
            got = [d]
            while queue and queue[0][:2] == (end, level):
                got.append(heapq.heappop(queue)[3])
            nodes[level].append(h("".join(got)))
            send(level, index // ARITY, nodes[level][-1])
    return nodes


def backward(nodes: list[list[str]], suffix: str) -> list[str]:
    """The paths of the leaves, from the suffix of the top node: labels fall, and each node hands its path to its children.

    A path has an entry 'before>after' for each level from the node up, ended by '|': the digests of the siblings."""
    paths = [suffix]
    for level in range(len(nodes) - 2, -1, -1):
        below = []
        for parent, path in enumerate(paths):
            run = nodes[level][parent * ARITY : (parent + 1) * ARITY]
            below += [f"{''.join(run[:k])}>{''.join(run[k + 1 :])}|{path}" for k in range(len(run))]
        paths = below
    return paths


def fold(d: str, path: str) -> str:
    """The root that a digest leads to along a path."""
    for entry in path.split("|")[:-1]:
        before, after = entry.split(">")
        d = h(before + d + after)
    return d


_BARE = str.maketrans("", "", ">|")


def _stretch(level: DataFrame, height: int) -> DataFrame:
    return level.withColumn("s", F.expr(f"i div {ARITY**height}"))


def _tree(t: pa.Table, height: int) -> tuple[pa.Table, list[list[str]]]:
    """A stretch in order, and its nodes."""
    t = t.sort_by("i")
    return t, forward([d.hex() for d in t.column("digest").to_pylist()], min(height, levels(t.column("n")[0].as_py())))


_NODE = "g string, i long, n long, digest binary"
_PATH = "g string, i long, path string, top string, root string"


def _up(level: DataFrame, height: int) -> DataFrame:
    """The tops of a level's stretches, as the next level."""

    def tops(t: pa.Table) -> pa.Table:
        t, nodes = _tree(t, height)
        n = -(-t.column("n")[0].as_py() // ARITY**height)
        return pa.table({"g": t.column("g")[:1], "i": t.column("s")[:1], "n": pa.array([n], pa.int64()), "digest": pa.array([bytes.fromhex(nodes[-1][0])], pa.binary())})

    return _stretch(level.select("g", "i", "n", "digest"), height).groupBy("g", "s").applyInArrow(tops, _NODE)


def _down(level: DataFrame, paths: DataFrame, height: int) -> DataFrame:
    """The paths of a level's nodes, from those of its stretches (g, i, path, top, root)."""

    def deliver(t: pa.Table, p: pa.Table) -> pa.Table:
        t, nodes = _tree(t, height)
        path, top, root = (p.column(c)[0].as_py() for c in ("path", "top", "root"))
        n = t.num_rows
        return pa.table({"g": t.column("g"), "i": t.column("i"), "path": backward(nodes, path), "top": pa.array([top] * n, pa.string()), "root": pa.array([root] * n, pa.string())})

    return _meet(level.select("g", "i", "n", "digest"), paths, height).applyInArrow(deliver, _PATH)


def _meet(level: DataFrame, paths: DataFrame, height: int):
    return _stretch(level, height).groupBy("g", "s").cogroup(paths.withColumnRenamed("i", "s").groupBy("g", "s"))


def _rounds(level: DataFrame, height: int) -> list[DataFrame]:
    """All levels of stretches from this one up, to the one where each group has one node."""
    most = level.agg(F.max("n")).first()[0] or 1
    out = [level]
    while most > 1:
        out.append(staged(_up(out[-1], height), "nodes"))
        most = -(-most // ARITY**height)
    return out


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", key: str = "doc_id", tampered: dict[str, Column] | None = None, when: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """One row per row of docs: the key, leaf, subroot, root, proof (the path's sibling digests, hashed), folded_root and verified.

    tampered gives changed values of some fields for the rows where when holds: folded_root is
    recomputed from the changed row and the siblings of the unchanged tree."""
    leaf = digest(*[F.col(f) for f in fields])
    other = digest(*[(tampered or {}).get(f, F.col(f)) for f in fields])
    leaves = docs.select(F.when(F.col(group).isNull(), "-").otherwise(F.concat(F.lit("="), F.col(group))).alias("g"), F.col(key).alias("key"), leaf.alias("digest"), (F.when(when, other) if tampered else F.lit(None).cast("binary")).alias("other"))
    # the last key tells equal rows apart, so that any number of them can be dealt to several partitions
    leaves = staged(leaves, "leaves").withColumn("tie", F.monotonically_increasing_id())
    leaves = ranked(leaves, ["g"], [F.col("key").asc_nulls_first(), F.col("digest"), F.col("other"), F.col("tie")], "rn", "n").select("g", (F.col("rn") - 1).alias("i"), "n", "key", "digest", "other")

    trees = _rounds(leaves, height)
    # the groups' roots, in order, are the leaves of one more tree
    of = ranked(trees[-1].select(F.lit("").alias("all"), "g", "digest"), ["all"], [F.col("g")], "rn", "n").select(F.col("all").alias("g"), (F.col("rn") - 1).alias("i"), "n", "digest", F.col("g").alias("name"))
    of = staged(of, "subroots")
    above = _rounds(of, height)
    root = F.lower(F.hex("digest"))
    paths = above[-1].select("g", "i", F.lit("").alias("path"), F.lit("").alias("top"), root.alias("root"))
    for level in above[-2::-1]:
        paths = _down(level, paths, height)
    paths = of.join(paths.select("i", "path", "root"), "i").select(F.col("name").alias("g"), F.lit(0).cast("long").alias("i"), "path", root.alias("top"), "root")
    for level in trees[-2:0:-1]:
        paths = _down(level, paths, height)

    schema = f"{key} {docs.schema[key].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"

    def deliver(t: pa.Table, p: pa.Table) -> pa.Table:
        t, nodes = _tree(t, height)
        suffix, top, root = (p.column(c)[0].as_py() for c in ("path", "top", "root"))
        out = backward(nodes, suffix)
        changed = [d.hex() if d is not None else leaf for d, leaf in zip(t.column("other").to_pylist(), nodes[0], strict=True)]
        folded = [fold(d, path) for d, path in zip(changed, out, strict=True)]
        n = t.num_rows
        same = lambda x: pa.array([x] * n, pa.string())
        proofs = [h(path.translate(_BARE)) for path in out]
        return pa.table({key: t.column("key"), "leaf": nodes[0], "subroot": same(top), "root": same(root), "proof_sha256": proofs, "folded_root": folded, "verified": pa.array([f == root for f in folded], pa.bool_())})

    return _meet(leaves, paths, height).applyInArrow(deliver, schema)
