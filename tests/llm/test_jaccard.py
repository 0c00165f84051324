import random
import re

import numpy as np
import pytest

from trawl.llm import common, jaccard, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingled(t):
    w = WORD.findall((t or "").translate(UPPER))
    return frozenset(tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset()


def brute(rows):
    s = [shingled(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            n = len(s[i] & s[j])
            if n and 100 * n >= 85 * len(s[i] | s[j]) and None not in (rows[i][0], rows[j][0]):
                up[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(d, low.get(root(i), d))
    return sorted(((d, len(s[i]), None if d is None else low[root(i)]) for i, (d, _) in enumerate(rows)), key=str)


def corpus(rnd, families=12, members=9):
    vocabulary = ["".join(rnd.choice("abcdé") for _ in range(4)) for _ in range(3000)]
    line = " ".join(rnd.choice(vocabulary) for _ in range(25))
    out = []
    for f in range(families):
        n = rnd.choice([3, 4, 5, 7, 9, 60, 150, 400])
        words = [rnd.choice(vocabulary) for _ in range(n)]
        for _ in range(members):
            w = list(words)
            for _ in range(rnd.randint(0, max(1, n // 40))):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            if rnd.random() < 0.3:
                w = w[: max(1, len(w) - rnd.randint(0, max(1, n // 12)))]
            if rnd.random() < 0.3:
                w.append(line)
            out.append(rnd.choice([" ", "\n", "  "]).join(w))
    out += [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 200))) for _ in range(30)]
    return out


def test_shingles():
    rnd = random.Random(1)
    texts = [None, "", " \t ", "a", "A b", "a b c", "a b c d", "a B c d e", "x\xa0y z", "é É", *corpus(rnd, 3, 3)]
    known = {}
    for size in (1, 50, 1 << 18):
        for t, got in zip(texts, shingles.sets(texts, 4, size), strict=True):
            want = shingled(t)
            assert len(got) == len(want) and (np.diff(got.astype(object)) > 0).all()
            assert known.setdefault(want, got.tolist()) == got.tolist()


@pytest.mark.parametrize("seed", range(3))
def test_trees(seed):
    rnd = random.Random(seed)
    rows = [(i, t) for i, t in enumerate(corpus(rnd))]
    sets = list(shingles.sets([t for _, t in rows]))
    up = list(range(len(rows)))
    for i, j in jaccard.tree_join(sets):
        a, b = up[i], up[j]
        up = [min(a, b) if x in (a, b) else x for x in up]
    want = {d: c for d, _, c in brute(rows)}
    assert all((up[i] == up[j]) == (want[i] == want[j]) for i in range(len(rows)) for j in range(i))
    half = len(sets) // 2
    links = jaccard.tree_join(sets[:half], sets[half:])
    for i, j in links:
        n = len(np.intersect1d(sets[i], sets[half + j]))
        assert 100 * n >= 85 * (len(sets[i]) + len(sets[half + j]) - n)


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    rnd = random.Random(5 + small)
    if small:  # many blocks, and joins in place of broadcasts
        monkeypatch.setattr(jaccard, "BLOCK", 3)
        monkeypatch.setattr(jaccard, "SENT", 0)
        monkeypatch.setattr(jaccard, "SAMPLE", 50)
    rows = [(1000 - 3 * i, t) for i, t in enumerate(corpus(rnd))]
    rows += [(5, None), (6, ""), (7, "  \n"), (None, rows[3][1]), (rows[8][0], rows[30][1]), (2000, rows[4][1]), (2001, "long " * 20_000 + "tail"), (2002, "LONG " * 20_000 + "tail")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n int, cid long").repartition(4)
    got = jaccard.join(df).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)


@pytest.mark.parametrize("part", [50, 80, 85, 95])
def test_linked_sets_share_a_key(part):
    rnd = np.random.default_rng(part)
    cuts, starts, most = jaccard.parts_of(part), jaccard.edges(part), 0
    for n in [*range(1, 140), 199, 400, 1000, 5000]:
        a = np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64))
        frequent = np.sort(rnd.permutation(a)[: rnd.integers(0, n + 1)])
        for added in {0, jaccard.differing(n, part) // 2, 100 * n // part - n}:
            b = np.concatenate([a, rnd.integers(0, 1 << 63, added, dtype=np.uint64)])
            # as many others as may go
            gone = next(g for g in range(n - 1, -1, -1) if 100 * (n - g) >= part * len(b))
            b = np.sort(rnd.permutation(b) if gone == 0 else np.concatenate([rnd.permutation(a)[gone:], b[n:]]))
            both = [jaccard.keys_of(x, frequent, int(np.searchsorted(starts, len(x), "right")), cuts, part) for x in (a, b)]
            assert not both[0][2] + both[1][2]
            assert len(np.intersect1d(np.concatenate(both[0][:2]), np.concatenate(both[1][:2])))
            most = max(most, sum(map(len, both[0][:2])) / n)
    assert part == 50 or most <= 4


def test_parts_too_few(spark, monkeypatch):
    """Shingles that lie in fewer parts than may differ: single shingles are the keys."""
    real = jaccard.parts_of
    assert jaccard.keys_of(np.arange(1, 301, dtype=np.uint64) << np.uint64(32), np.zeros(0, np.uint64), 20, [128] * 99)[2] == [20]
    monkeypatch.setattr(jaccard, "parts_of", lambda part, tokens=frozenset(): [0 if g in tokens else min(p, 1) for g, p in enumerate(real(part))])
    rows = list(enumerate(corpus(random.Random(3), 5, 5)))
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)


def test_common_phrases_make_no_family(spark, monkeypatch):
    """Texts of a few words share most of their shingles with some other text each, and link with none: their sets aren't sent to be compared."""
    rnd, sent = random.Random(7), {}
    rows = [(i, " ".join(rnd.choice("abcdefghij") for _ in range(110))) for i in range(400)]
    rows += [(1000 + i, t + " k") for i, t in rows[:3]]
    real = jaccard.staged

    def staged(df, name):
        out = real(df, name)
        sent[name] = out.count()
        return out

    monkeypatch.setattr(jaccard, "staged", staged)
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)
    assert 6 <= sent["members"] < 30


def test_keys_are_deleted(spark, monkeypatch):
    """Once families are known, what they were found by takes no room."""
    import os

    at, real = {}, jaccard.staged
    monkeypatch.setattr(jaccard, "staged", lambda df, name: at.setdefault(name, []).append(real(df, name)) or at[name][-1])
    jaccard.join(spark.createDataFrame(list(enumerate(corpus(random.Random(8), 3, 3))), "doc_id long, text string")).collect()
    there = [x for name in at for x in at[name] if os.path.exists(x.staged_at.removeprefix("file://")) and {"keys", "key", "late"} & set(x.columns)]
    assert not there


def test_one_of_each(spark):
    rnd = random.Random(9)
    texts = corpus(rnd, 6, 5)
    rows = [(i, t, "x", 5) for i, t in enumerate(texts)] + [(500, None, "x", 5), (501, "", "x", 5), (None, texts[0], "x", 5), (0, texts[0], "x", 5), (1, texts[-1], "x", 5), (502, texts[3], "x", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _hash string, component_id long")
    got = jaccard.one_of_each(df, words=4, part=85)
    assert got.columns == df.columns
    want = {i: c for i, _, c in brute([(n, r[1]) for n, r in enumerate(rows)])}
    # the row with the smallest id of each group; -1 for none
    groups = {}
    for n, r in enumerate(rows):
        if r[0] is not None:
            groups.setdefault(want[n], []).append((r[0], n))
    kept = sorted(((r.doc_id if r.doc_id is not None else -1), r.text or "") for r in got.collect())
    assert kept == sorted([(min(g)[0], rows[min(g)[1]][1] or "") for g in groups.values()] + [(-1, texts[0])])


def test_empty(spark):
    assert jaccard.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1060)] + [(7, 7)]
    up = {x: x for e in edges for x in e}
    for a, b in edges:
        a, b = up[a], up[b]
        up = {k: min(a, b) if v in (a, b) else v for k, v in up.items()}
    assert {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()} == up
