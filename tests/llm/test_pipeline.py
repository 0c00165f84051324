import random

import corpus_pipeline
from trawl.llm import pii

WORDS = {"en": "the and thing house water they with river stone", "de": "der und schön haus wasser mit für stein fluss"}


def test_stages_and_run(spark, tmp_path):
    rnd = random.Random(4)
    text = lambda lang, n: " ".join(rnd.choice(WORDS[lang].split()) + rnd.choice(["", "s", "en", "ly"]) for _ in range(n))
    rows = [(i, text(lang := rnd.choice(list(WORDS)), rnd.randint(60, 120)), lang, "s", 0) for i in range(300)]
    base = rows[10][1]
    item = " ".join(f"bench{i % 7}mark word{i}" for i in range(12))
    planted = {
        1000: "12345 !!! 999", 1001: None, 1002: "",
        1010: base, 1011: base + " water", 1012: base.upper(),
        1020: text("en", 40) + " " + item + " " + text("en", 40),
        1030: text("en", 50) + " joe.12@mail1.example.com and +1 (269) 555-3296 " + text("en", 20),
    }
    rows += [(i, t, "en", "s", 0) for i, t in planted.items()]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        if i < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            docs.write.parquet(f"{tmp_path}/{i}")
            docs = spark.read.parquet(f"{tmp_path}/{i}")
        seen[name] = {r[0]: r for r in docs.collect()}
    clean = {r[0] for r in rows[:300]}
    assert set(seen["language"]) == clean | set(planted) - {1000, 1001, 1002}
    assert set(seen["near_duplicates"]) == set(seen["language"]) - {1010, 1011, 1012}
    assert set(seen["decontamination"]) == set(seen["near_duplicates"]) - {1020}
    masked = seen["personal_data"]
    assert set(masked) == set(seen["decontamination"]) and "<EMAIL>" in masked[1030].text and "<PHONE>" in masked[1030].text and not pii.base_spans(masked[1030].text)
    assert all(r.n_chars == len(r.text) for r in masked.values())
    assert all(masked[i].text == r[1] for i, r in ((r[0], r) for r in rows[:300]))
    assert set(seen["packing"]) == set(masked)
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(masked)
    empty = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
