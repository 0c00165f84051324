"""Ranked search against brute force; the pruning is counted."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.llm import ranking

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    bags = [(d, Counter(cut(t))) for d, t in docs if cut(t)]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    queries = defaultdict(list)
    for i, t in items:
        queries[i] += cut(t)
    out = []
    for i, q in queries.items():
        scored = []
        for d, b in bags:
            m = 25 + 75 * sum(b.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * b[w] // (1000 * b[w] + 8 * m)) for w in q if w in b)
            if s > 0:
                scored.append((-s, d is not None, d or 0, d))
        out += [(i, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


WORDS = ["the", "The", "of", "été", "ÉTÉ", "日本", "a1", "x-y", "zz_top", " ", "don't"] + [f"w{i}" for i in range(120)]


def make(n, seed):
    r = random.Random(seed)
    text = lambda: r.choice([None, "", "!!", " ".join(r.choices(WORDS, [40] * 11 + [1] * 120, k=r.randint(1, 80)))])
    docs = [(r.choice([None, 5, *[i] * 8]), text() if r.random() < 0.3 else " ".join(r.choices(WORDS, k=r.randint(1, 60)))) for i in range(n)]
    return docs + docs[:40]  # ties


@pytest.mark.parametrize("k", [1, 10])
def test_against_brute_force(spark, k):
    docs = make(400, k)
    # more than 64 terms, repeats, one id twice, nothing to find, no terms
    items = [(1, " ".join(WORDS)), (2, "the the of w1 w1 w1"), (2, "W2"), (3, "unknown"), (4, None), (5, "..."), (None, "w3 été"), *[(10 + i, d[1]) for i, d in enumerate(docs[:20])]]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("at", F.lit("clash")).withColumn("n", F.lit(1)).repartition(5)
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("term", F.lit(0)).withColumn("doc_id", F.lit(7))
    assert sorted(map(tuple, ranking.search(d, q, k).collect()), key=str) == brute(docs, items, k)


def test_passes(spark, monkeypatch):
    monkeypatch.setattr(ranking, "VOCABULARY", 30)
    docs, items = make(100, 3), [(i, f"w{i} w{i + 1} the") for i in range(60)]
    got = ranking.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 4)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, 4)


def test_empty(spark):
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = some.toDF("item_id", "text")
    assert ranking.search(none, items).collect() == []
    assert ranking.search(some, items.limit(0)).collect() == []
    assert [tuple(r)[:3] for r in ranking.search(some, items).collect()] == [(1, 1, 1)]


def test_long_texts_are_cut_whole():
    text = ("Word " * 300_000 + "x" * 2_000_000 + " ÉTÉ-end").encode()
    assert [w for p in ranking.terms(text) for w in p] == [b"word"] * 300_000 + [b"x" * 2_000_000, "ÉtÉ".encode(), b"end"]


def test_masks_are_left_out():
    """Of documents with one common term each, and some with a rare one besides, few are scored."""
    r = np.random.default_rng(0)
    n = 10_000
    common, rare = np.arange(n), r.choice(n, 50, replace=False)
    at, doc = np.r_[np.zeros(n, int), np.ones(50, int)], np.r_[common, rare]
    block = ranking.Block(np.arange(n), np.full(n, 100), doc, at, r.integers(1, 4, len(at)))
    best, scored = block.best(np.array([0, 1]), np.array([10, 5000]), 10, [])
    assert scored == 50 and {d for _, d in best} <= set(rare.tolist())
    assert block.best(np.array([0]), np.array([10]), 10, best) == (best, 0)
