"""The automaton against merging by priority, and the operator against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from trawl.llm import automaton
from trawl.llm.automaton import Automaton

LETTERS = list("abcdefghijklmnopqrstuvwxyzAÉéßñİΣς'’ .,;:!?0123456789-_=/\\\t\n\r  ́̈日本語한글🙂👍🏽\x1c\x85᠎﻿") + ["<|endoftext|>", "<|startoftext|>", "the", "ing", "'s", "'LL", "ǅ", "ﬁ", "Å"]


def merged(word, merges):
    """Merge by merge, each everywhere from left to right."""
    parts = list(word)
    for a, b in merges:
        out, i = [], 0
        while i < len(parts):
            if parts[i : i + 2] == [a, b]:
                out.append(a + b)
                i += 2
            else:
                out.append(parts[i])
                i += 1
        parts = out
    return parts


@pytest.mark.parametrize("seed", range(30))
def test_automaton_accepts_the_merged_sequence_alone(seed):
    r = random.Random(seed)
    tokens, merges = list("abc"), []
    while len(merges) < 40:
        a, b = r.choice(tokens), r.choice(tokens)
        if a + b not in tokens and len(a + b) < 7:
            merges.append((a, b))
            tokens.append(a + b)
    number = {t: i for i, t in enumerate(tokens)}
    m = Automaton(number, merges)

    def accepted(word, state):
        if not word:
            return [[]]
        return [[t, *rest] for t in tokens if word.startswith(t) and (to := m.arc(state, number[t])) >= 0 for rest in accepted(word[len(t) :], to)]

    for _ in range(60):
        word = "".join(r.choices("abc", k=r.randint(0, 9))) if r.random() < 0.8 else r.choice("abc") * r.randint(1, 9)
        assert accepted(word, 0) == [merged(word, merges)]


def test_improper_merges_raise():
    with pytest.raises(ValueError):
        Automaton({"a": 0, "b": 1, "ab": 2, "abb": 3}, [("ab", "b"), ("a", "b")])


@pytest.fixture(scope="module", params=["word_bpe_49k.json", "byte_bpe_50k.json"])
def both(request):
    path = public_tokenizers.path(request.param)
    return automaton.tokenizer(path), tokenizers.Tokenizer.from_file(path), path


def same(own, lib, text):
    ids = lib.encode(text, add_special_tokens=False).ids
    got = own.encode(text)
    return np.frombuffer(got, "<u4").tolist() == ids and own.decode(got) == lib.decode(ids, skip_special_tokens=False)


def test_texts(both):
    own, lib, _ = both
    r = random.Random(5)
    for i in range(6000):
        assert same(own, lib, "".join(r.choices(LETTERS, k=r.randint(0, 40))))
        word = "".join(r.choices("aehtinosrdlucm", k=r.randint(1, 90))) if i % 2 else r.choice("ah=-.") * r.randint(1, 200)
        assert same(own, lib, word)


def test_long_words(both):
    own, lib, _ = both
    assert same(own, lib, "abcd" * 30_000) and same(own, lib, "=" * 70_000 + " x" * 50_000)


def test_words_are_forgotten(both, monkeypatch):
    own, lib, _ = both
    monkeypatch.setattr(automaton, "WORDS", 3)
    assert all(same(own, lib, f"one two{i} three four{i} <|endoftext|>") for i in range(50))


def test_operator(spark, both):
    _, lib, path = both
    rows = [(1, "Hello, world's <|endoftext|> end"), (None, None), (2, ""), (2, "x" * 3000), (2, ""), (7, "日本語 \n\n é")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("n_tokens", F.lit("clash"))
    got = automaton.decoded(automaton.encoded(df, path), path).collect()
    want = []
    for doc, text in rows:
        ids = lib.encode(text or "", add_special_tokens=False).ids
        want.append((doc, len(ids), np.array(ids, "<u4").tobytes(), lib.decode(ids, skip_special_tokens=False)))
    assert sorted([(r[0], r[1], bytes(r[2]), r[3]) for r in got], key=str) == sorted(want, key=str)
    assert automaton.decoded(automaton.encoded(df.limit(0), path), path).collect() == []


def test_query(spark):
    from trawl.llm.q_automaton import op11_merge_automaton

    sf = "/root/testdata/sf0.001"
    lib = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: tuple(r)[1:] for r in op11_merge_automaton(spark, sf).collect()}
    for doc, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = lib.encode(text or "", add_special_tokens=False).ids
        assert got[doc] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())
