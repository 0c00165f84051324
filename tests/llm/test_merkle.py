"""The manifest against a tree built in memory."""

import hashlib
import random
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from trawl.llm import merkle
from trawl.llm.common import fold

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(doc, text, lang, source, n):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def climb(nodes):
    """[(leaf digest)] -> root and each leaf's list of (before, after)."""
    paths, of = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, groups = [], []
        for at in range(0, len(nodes), 8):
            run = nodes[at : at + 8]
            for k in range(len(run)):
                for i in of[at + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(h("".join(run)))
            groups.append([i for k in range(len(run)) for i in of[at + k]])
        nodes, of = up, groups
    return nodes[0], paths


def brute(rows):
    key = lambda r: (r[2] is not None, (r[2] or "").encode(), r[0] is not None, r[0] or 0, leaf(*r))
    langs = [(g, list(m)) for g, m in groupby(sorted(rows, key=key), key=lambda r: r[2])]
    trees = [climb([leaf(*r) for r in m]) for _, m in langs]
    if not trees:
        return []
    root, above = climb([t[0] for t in trees])
    out = []
    for (_, members), (sub, paths), top in zip(langs, trees, above, strict=True):
        for r, path in zip(members, paths, strict=True):
            at = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                at = (r[0], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]), *r[2:])
            f = leaf(*at)
            for b, a in path + top:
                f = h(b + f + a)
            out.append((r[0], leaf(*r), sub, root, h("".join(b + a for b, a in path + top)), f, f == root))
    return out


def order(rows):
    return sorted(rows, key=str)


def run(df, height):
    return order(map(tuple, merkle.manifest(df, tampered={"text": F.translate("text", merkle.UPPER, merkle.LOWER)}, when=fold("doc_id", 3) == 0, height=height).collect()))


def make(n, langs, seed=0):
    r = random.Random(seed)
    text = lambda: r.choice([None, "", "Ab É ß", "plain", "日本 Text", "x" * 5000 + "Q"])
    return [(r.choice([None, 7, i]), text(), r.choice(langs), r.choice([None, "s", "ü"]), r.choice([None, 5])) for i in range(n)]


@pytest.mark.parametrize("n,langs,height", [(700, ["en"] * 5 + ["é", None], 1), (300, [str(i) for i in range(90)], 2), (200, ["x"], 4), (1, [None], 4), (9, ["a"], 1)])
def test_against_brute_force(spark, n, langs, height):
    rows = make(n, langs)
    rows += rows[:5]  # repeated rows
    df = spark.createDataFrame(rows, SCHEMA).withColumn("g", F.lit("clash")).withColumn("i", F.lit(1)).withColumn("path", F.lit("x")).withColumn("digest", F.lit(None))
    assert run(df.repartition(6), height) == order(brute(rows))


def test_empty(spark):
    assert run(spark.createDataFrame([], SCHEMA), 2) == []


def test_tampering_shows(spark):
    rows = [(i, f"Text {i}" if i % 2 else f"text {i}", "en", "s", 3) for i in range(60)]
    out = {r[0]: r for r in run(spark.createDataFrame(rows, SCHEMA), 2)}
    for i, r in out.items():
        assert r[6] == (i % 2 == 0 or zlib.crc32(str(i).encode()) % 3 != 0)


def test_sweeps():
    nodes = merkle.forward([h(str(i)) for i in range(77)], 3)
    assert [len(x) for x in nodes] == [77, 10, 2, 1]
    assert {merkle.fold(d, p) for d, p in zip(nodes[0], merkle.backward(nodes, ""), strict=True)} == {nodes[3][0]}
