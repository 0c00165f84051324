import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from trawl.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", "   ", "The THE the, the. it's It'S", "a.,b ,. x,'s ,", "É é é İstanbul ſ ß ﬁ", "tab\tand\x1cnbsp\xa0end\n\nline\r\n", "<|endoftext|> x<|startoftext|>y,", "日本語 text, Ω Σ ς", "12345 3.14, 7.", "word " * 30000, "e ́ ́a"]


def test_encoder_equals_tokenizer(monkeypatch):
    t = Tokenizer.from_file(PATH)
    rnd = random.Random(3)
    extra = ["".join(rnd.choice("abC,.' é́İ\n1-ſ\x1c") for _ in range(40)) for _ in range(300)]
    monkeypatch.setattr(tokens, "WORDS", 50)
    e = tokens.Encoder(PATH)
    for some in (TEXTS, extra[:150], extra[150:]):
        for text, got in zip(some, e(some), strict=True):
            assert got.tolist() == t.encode(text or "", add_special_tokens=False).ids, text


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_shard(n):
    rng = np.random.default_rng(n)
    v = rng.integers(0, 300, n)
    s = tokens.Shard(tokens.pack(np.array([5]), np.array([n]), v))
    assert s.tokens().tolist() == v.tolist()
    for i in range(0, n, 97):
        assert s.access(i) == v[i]
        assert s.rank(int(v[i]), i) == int((v[:i] == v[i]).sum())
        assert s.select(int(v[i]), s.rank(int(v[i]), i)) == i
    for token in (0, 7, 299, 4000):
        assert s.count(token) == int((v == token).sum())
        assert s.select(token, s.count(token)) == -1


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(tokens, "SHARD", 100)
    rows = [(i * 3, t, "part", 1) for i, t in enumerate(TEXTS * 3)] + [(9, TEXTS[3], "again", 2), (None, "no id", "x", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, part string, shard int").repartition(3)
    shards = tokens.write_shards(df, PATH)
    got = tokens.read_documents(shards).orderBy("start").collect()
    t = Tokenizer.from_file(PATH)
    at = 0
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [r[0] for r in want]
    n_five = 0
    for r, (_, text, *_) in zip(got, want, strict=True):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids))
        at += len(ids)
        n_five += int((ids == 1).sum())
    assert tokens.occurrences(shards, 1).agg({"n": "sum"}).first()[0] == n_five
    none = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.read_documents(tokens.write_shards(none, PATH)).count() == 0


def test_repeated_ids_have_one_order_and_other_tokenizers_whole_texts(spark, tmp_path):
    rows = [(7, f"text {i}") for i in range(50)]
    runs = []
    for n in (1, 4):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(n)
        runs.append([(r.start, r.ids_crc32) for r in tokens.read_documents(tokens.write_shards(df, PATH)).orderBy("start").collect()])
    assert runs[0] == runs[1]
    from tokenizers import models

    t = Tokenizer(models.BPE(vocab={"a": 0, " ": 1, "a ": 2, "b": 3}, merges=[("a", " ")]))
    t.save(f"{tmp_path}/blanks.json")
    e = tokens.Encoder(f"{tmp_path}/blanks.json")
    assert not e.by_words and e(["a b"])[0].tolist() == [2, 3]
    assert tokens.Encoder(PATH).by_words
