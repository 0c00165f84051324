import itertools
import random
from collections import Counter, defaultdict

import public_tokenizers
from tokenizers import Tokenizer

from pyspark.sql import functions as F

import corpus_pipeline
from trawl.llm import packing, q_packing, tokens


def padding(bounds, lengths):
    return sum(min(b for b in bounds if b >= x) - x for x in lengths)


def test_boundaries_are_optimal():
    rnd = random.Random(2)
    for _ in range(60):
        lengths = [rnd.randint(0, 30) for _ in range(rnd.randint(1, 40))]
        c = Counter(lengths)
        for k in (1, 2, 3, 4):
            got = packing.boundaries(list(c), list(c.values()), k)
            least = min(padding([*x, max(lengths)], lengths) for n in range(min(k, len(c))) for x in itertools.combinations(sorted(c), n))
            assert len(got) <= k and padding(got, lengths) == least
    assert packing.boundaries([], [], 4) == []


def test_batches(spark, monkeypatch):
    monkeypatch.setattr(packing, "CELL", 8)
    rnd = random.Random(5)
    rows = [(i, " ".join(["w"] * rnd.choice([0, 1, 5, 5, 5, 40, 41, 300])), "x", 7) for i in range(400)] + [(3, "a b", "dup", 7), (400, None, "x", 7), (401, "w\n" * 9000, "x", 7), (None, "a", "x", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, bucket string, batch int").repartition(5)
    got = packing.pack(df, buckets=4, budget=1000).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in got) == sorted((i or -1, len((t or "").split())) for i, t, *_ in rows)
    batches = defaultdict(list)
    for r in got:
        assert r.n_tokens <= r.bucket_len
        batches[r.bucket, r.batch].append(r)
    last = {b: max(x for y, x in batches if y == b) for b, _ in batches}
    for (b, n), rs in batches.items():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
        assert len(rs) * rs[0].bucket_len <= max(1000, rs[0].bucket_len)
        assert n == last[b] or len(rs) == rs[0].batch_docs
    assert len({r.bucket for r in got}) <= 4
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_lengths_are_tokens(spark, tmp_path):
    """In op8 and in the pipeline's stage: the tokenizer's count and the end id; the length in words says something else."""
    texts = [None, "", "one", "日本語日本語日本語", "QUJD" * 3000, "a b c " * 40, "unbelievably internationalised " * 4000, "x" * 70_000]
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: len(t.encode(x or "", add_special_tokens=False).ids) + 1 for i, x in enumerate(texts)}
    assert want[3] > 2 and want[4] > 1000
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for got in (q_packing.op8_length_buckets(spark, str(tmp_path)), corpus_pipeline.batches(spark, docs, str(tmp_path))):
        rows = {r.doc_id: r for r in got.collect()}
        assert {i: r.n_tokens for i, r in rows.items()} == want
        # 16 buckets hold each of these lengths, and none within the budget is rounded
        assert all(r.bucket_len == r.n_tokens for r in rows.values() if r.n_tokens <= 65_536)
        assert all(r.batch_docs == max(1, 65_536 // r.bucket_len) for r in rows.values())


def test_batches_of_token_ids(spark):
    """Every id of every document stands in one batch, padded to the bucket's length and within the budget."""
    rows = [(i, "word " * (i % 7) + "end") for i in range(60)] + [(None, "no id"), (3, "again")]
    docs = tokens.encoded(spark.createDataFrame(rows, "doc_id long, text string"), public_tokenizers.path("word_bpe_49k.json"))
    want = Counter((r.doc_id, tuple(r.ids)) for r in docs.collect())
    out = packing.batched(packing.pack(docs, buckets=3, budget=40, length=docs["n_tokens"], keep=("ids",)), "ids").collect()
    got = Counter()
    for b in out:
        assert len(b.docs) * b.bucket_len <= max(40, b.bucket_len) and [d.slot for d in b.docs] == list(range(len(b.docs)))
        for d in b.docs:
            assert len(d.ids) == b.bucket_len
            got[d.doc_id, tuple(x for x in d.ids if x)] += 1
    assert got == Counter({(i, tuple(x for x in ids if x)): n for (i, ids), n in want.items()})


def test_long_lengths_and_hot_ids(spark):
    """Bounds are lengths of documents even above EXACT; ten thousand rows without an id are numbered in many cells."""
    df = spark.createDataFrame([(i, 70_000 + i * 37) for i in range(50)] + [(None, 5)] * 10_000, "doc_id long, n long")
    got = packing.pack(df, buckets=2, budget=100, length=F.col("n")).collect()
    assert {r.bucket_len for r in got} <= {r.n_tokens for r in got} and len(got) == 10_050
    short = sorted((r.batch, r.slot) for r in got if r.n_tokens == 5)
    assert short == [(i // 20, i % 20) for i in range(10_000)]
