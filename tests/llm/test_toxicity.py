import random
from collections import Counter

import numpy as np

from trawl.llm import q_toxicity, toxicity


def data(n):
    rnd = random.Random(7)
    good, bad = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)], ["vilea", "vileb", "vilec", "viled"]
    out = []
    for i in range(n):
        y = int(rnd.random() < 0.25)
        t = [rnd.choice(good) for _ in range(rnd.randint(10, 60))]
        for _ in range(rnd.randint(2, 4) * y):
            t.insert(rnd.randrange(len(t)), rnd.choice(bad))
        out.append((i, " ".join(t), y))
    return out


def test_nearest_is_exact():
    """Against all cosines, over the whole vocabulary; and most blocks are never scored."""
    d = data(700)
    bags = [Counter(toxicity.words(t)) for _, t, _ in d]
    terms = sorted(set().union(*bags))
    weight = np.linspace(1, 3, len(terms)) * np.where([t.startswith(b"vile") for t in terms], 3, 0.1)
    index = toxicity.Index(terms, weight, [(i, y, b) for (i, _, y), b in zip(d, bags, strict=True)], (525, 175))
    dense = np.zeros((len(index.ids), len(terms)))
    where = {i: r for r, i in enumerate(index.ids)}
    for (i, _, _), b in zip(d, bags, strict=True):
        t, w = index.vector(b)
        dense[where[i], t] = w
    for j, (_, t, _) in enumerate(data(60)):
        terms_, w = index.vector(Counter(toxicity.words(t)))
        q = np.zeros(len(terms))
        q[terms_] = w
        full = np.round(dense @ q, 6)
        own = int(index.ids[j]) if j % 2 else None
        want = sorted((r for r in range(len(full)) if full[r] > 0 and index.ids[r] != own), key=lambda r: (-full[r], index.ids[r]))[:9]
        cosine, row = index.nearest(terms_, w, own=own, k=9)
        assert np.allclose(cosine, full[want], atol=2e-6) and len(set(row)) == len(want)
        if len(set(np.round(full[want], 5))) == 9:
            assert row.tolist() == want


def test_document_frequencies_cover_all_rows(spark):
    df = spark.createDataFrame([("a b b",), ("b c",), (None,), ("",), ("zz b",)] * 50, "text string").repartition(3)
    assert toxicity.document_frequencies(df, [b"a", b"b", b"c", b"none"]).tolist() == [50, 150, 50, 0]


def test_held_out(spark, tmp_path):
    d = data(1500)
    docs = [(i, t, "s", 1.0) for i, t, _ in d] + [(5000, None, "s", 1.0), (5001, "", "s", 1.0), (5002, "vilea vileb " + "wab " * 100_000, "s", 1.0), (3, d[3][1], "again", 1.0), (None, "vilea", "s", 1.0)]
    spark.createDataFrame(docs, "doc_id long, text string, neighbours string, score double").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, y) for i, _, y in d] + [(3, 1, d[3][2]), (4, 0, None), (None, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = q_toxicity.op6_toxicity_neighbours(spark, str(tmp_path)).collect()
    assert len(got) == len(docs)
    y = {i: v for i, _, v in d}
    tried = [r for r in got if r.held_out and r.doc_id in y]
    assert len(tried) > 200 and np.mean([r.predicted == y[r.doc_id] for r in tried]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert next(r for r in got if r.doc_id == 5000).predicted == 0


def test_one_class_or_none(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    one = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert [r.score for r in toxicity.score(docs, toxicity.fit(docs, one)).collect()] == [0, 0]
    assert [r.score for r in toxicity.score(docs, toxicity.fit(docs, one.limit(0))).collect()] == [0, 0]
