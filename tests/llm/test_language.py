import random
from collections import Counter

import numpy as np

from trawl.llm import language, q_language

WORDS = {"en": "the and thing house water they with", "de": "der und schön haus wasser mit für", "fr": "le et très maison été avec où", **{f"l{i}": " ".join(chr(97 + i) * 2 + chr(97 + (i * j) % 26) + "xq" for j in range(1, 9)) for i in range(9)}}


def text(rnd, lang, n):
    return " ".join(rnd.choice(WORDS[lang].split()) for _ in range(n))


def rows(n):
    rnd = random.Random(1)
    return [(i, text(rnd, lang := list(WORDS)[i % len(WORDS)], rnd.randint(4, 40)), lang, "x", 0.5) for i in range(n)]


def test_counts_against_exact_sets(spark):
    """Each language's corrected shares are those of its exact sets of n-grams, but for the filters' false positives."""
    d = rows(600)
    f = language.fit(spark.createDataFrame(d, "doc_id long, text string, lang string, known string, score double"))
    exact = {l: Counter(g for t in {r[1] for r in d if r[2] == l} for g in set(language.grams(t).tolist())) for l in WORDS}
    size = {l: len({r[1] for r in d if r[2] == l}) for l in WORDS}
    assert f.languages == sorted(WORDS)
    for text_ in [text(random.Random(i), l, 30) for i, l in enumerate(WORDS)] + ["the haus and les xq", "zzz"]:
        g = language.grams(text_).tolist()
        known, common = f.shares(text_)
        for l, k, c in zip(f.languages, known, common, strict=True):
            least = max(2, -(-size[l] // language.COMMON))
            in_it, often = np.mean([x in exact[l] for x in g]), np.mean([exact[l][x] >= least for x in g])
            assert abs(k - in_it) < 0.02 and abs(c - often) < 0.02
    # no false negative
    for l, name in enumerate(f.languages):
        at = language.slots(np.array(list(exact[name]), np.uint64))
        mask = np.bitwise_and.reduce([f.slices[l // 4][s] for s in at])
        assert (mask >> (2 * (l % 4)) & 1).all()


def test_ties_and_a_hot_text(spark):
    two = [(i, "abcdefg hijklmn", l, "x", 0.5) for i, l in enumerate(["b", "a"] * 20)]
    f = language.fit(spark.createDataFrame(two, "doc_id long, text string, lang string, known string, score double"))
    assert f.judge("abcdefg")[0] == "a"
    hot = [(i, "hot text again", "en", "x", 0.5) for i in range(3000)] + [(3000 + i, text(random.Random(i), "en", 9), "en", "x", 0.5) for i in range(3000)]
    f = language.fit(spark.createDataFrame(hot, "doc_id long, text string, lang string, known string, score double"))
    assert f.shares("the water and they with")[1][0] > 0.9


def test_held_out_accuracy(spark, tmp_path):
    d = rows(900)
    odd = [(1000, None, "en", "x", 0.5), (1001, "", "en", "x", 0.5), (1002, "12 345 !?", "en", "x", 0.5), (1003, "日本", None, "x", 0.5), (1004, text(random.Random(2), "de", 50_000), "de", "x", 0.5), (1, "the thing and the water", "en", "again", 0.5), (None, "the water and they", "en", "x", 0.5)]
    spark.createDataFrame(d + odd, "doc_id long, text string, lang string, known string, score double").write.parquet(f"{tmp_path}/documents.parquet")
    got = q_language.op1_language_bitmask(spark, str(tmp_path)).collect()
    assert len(got) == len(d) + len(odd)
    truth = {r[0]: r[2] for r in d}
    tried = [r for r in got if r.held_out and r.doc_id in truth and r.doc_id != 1]
    assert sum(r.lang_pred == truth[r.doc_id] for r in tried) > 0.97 * len(tried) > 100
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and by[1003].lang_pred in WORDS and by[1003].score == 0
    assert by[1004].lang_pred == "de" and all(0 <= r.score <= 1 for r in got)
    f = language.fit(spark.createDataFrame(d, "doc_id long, text string, lang string, known string, score double"))
    kept = language.accept(spark.createDataFrame(d + odd, "doc_id long, text string, lang string, known string, score double"), f)
    assert kept.columns == ["doc_id", "text", "lang", "known", "score"]
    assert {r.doc_id for r in kept.collect()} >= set(truth) and not {1000, 1001, 1002, 1003} & {r.doc_id for r in kept.collect()}


def test_nothing_to_learn(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    f = language.fit(none)
    assert f.judge("the water") == ("und", 0.0, 0.0) and language.predict(none, f).count() == 0
