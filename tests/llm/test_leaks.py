import random

import pytest

from trawl.llm import leaks


def brute(item: bytes, text: bytes) -> int:
    """Least edits between the item and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def edited(rnd, s, n):
    s = list(s)
    for _ in range(n):
        at = rnd.randrange(len(s))
        what = rnd.choice("sid")
        if what == "s":
            s[at] = rnd.choice("xyz")
        elif what == "i":
            s.insert(at, rnd.choice("xyz"))
        else:
            del s[at]
    return "".join(s)


@pytest.mark.parametrize("group", [4 << 20, 300])
def test_against_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(leaks, "GROUP", group)
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(rnd.randint(12, 30))) for i in range(8)] + [(90, "short"), (91, None), (92, "  "), (93, "the é item, of some lengthé")]
    docs = []
    for n in range(60):
        i = items[rnd.randrange(8)][1]
        docs.append((n, prose(rnd.randint(0, 40)) + " " + edited(rnd, i, rnd.randint(0, len(i) // 7)) + " " + prose(rnd.randint(0, 20)), "x", 0))
    docs += [(100, None, "x", 0), (101, "", "x", 0), (102, "A SHORT one", "x", 0), (103, items[0][1].upper().replace(" ", " \n "), "x", 0), (104, prose(3000) + items[1][1], "x", 0), (104, "again " + items[2][1] * 2, "x", 0), (105, "THE é item,  of some lengthé", "x", 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, items string, n_items int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    plain = [(i, leaks.plain(t)) for i, t in items if leaks.plain(t)]
    want = []
    for n, t, *_ in docs:
        t = leaks.plain(t)
        hits = {i: d for i, b in plain if (d := brute(b, t)) <= leaks.budget(len(b))} if len(t) < 3000 else {1: 0, 90: 0} if b"short" in t else {1: 0}
        want.append((n, len(hits), sorted(hits), [hits[i] for i in sorted(hits)]))
    got = [(r.doc_id, r.n_items, r["items"], r.edits) for r in leaks.find(df, bench).collect()]
    assert sorted(got) == sorted(want)
    kept = leaks.clean(df, bench)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(n for n, k, *_ in want if not k)
    assert leaks.find(df.limit(0), bench).count() == 0 and {r.n_items for r in leaks.find(df, bench.limit(0)).collect()} == {0}


@pytest.mark.parametrize("missing", [1, 2, 3])
def test_planted_items_with_words_missing(spark, missing):
    """Copies within a tenth of the item's length are found; the budget is worked out here and not asked of the module."""
    rnd = random.Random(missing)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 7)))
    items, docs = [], []
    for i in range(40):
        words = [word() for _ in range(rnd.randint(15, 50))]
        left = list(words)
        for _ in range(missing):
            del left[rnd.randrange(len(left))]
        items.append((i, " ".join(words)))
        docs.append((i, " ".join([word() for _ in range(30)] + left + [word() for _ in range(30)])))
    least = {i: brute(a.encode(), b.encode()) for (i, a), (_, b) in zip(items, docs, strict=True)}
    want = {i: d for i, d in least.items() if d * 10 <= len(items[i][1])}
    assert sum(d * 100 > 6 * len(items[i][1]) for i, d in want.items()) >= 3  # more than 6 %, as 12-grams allowed
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: dict(zip(r["items"], r.edits, strict=True)) for r in leaks.find(df, bench).collect()}
    assert {i: g[i] for i, g in got.items() if i in g} == want
    assert {r.doc_id for r in leaks.clean(df, bench).collect()}.isdisjoint(want)


def test_short_items_are_words(spark):
    docs = spark.createDataFrame([(1, "it was yesterday"), (2, "he said: Yes!"), (3, "eyes"), (4, "yes")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "yes"), (8, None), (9, "  ")], "item_id long, text string")
    assert {r.doc_id for r in leaks.find(docs, items).where("n_items > 0").collect()} == {2, 4}
    assert {r.doc_id for r in leaks.clean(docs, items).collect()} == {1, 3}
