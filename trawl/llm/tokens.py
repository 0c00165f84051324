"""Token ids in wavelet-matrix shards.

Documents are range-partitioned by id, so a partition holds a stretch of ids; each partition writes shards of about
SHARD tokens. A shard is one binary value: a header, the documents' ids and lengths, and per bit of the token ids
(highest first) one bit-plane with rank samples. A plane lists that bit of every token, the tokens being
stably parted by the bits above it. The planes give access, counting and occurrence lookup without decoding; the column
that holds the shards is compressed by Parquet (zstd).

Null texts count as empty; an empty text has the end id alone. Null ids are kept and come first. Repeated ids are
separate documents in the order of their texts' hashes, and by them a hot id is split. An empty table gives no shard and no row. Very long texts are
encoded whole and make a shard of their own size. Only key and text are read, so other columns' names can't clash.
"""

from __future__ import annotations

import os
import string
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import staged, trimmed

SHARD = 1 << 20
SAMPLE = 512  # bits from one rank sample to the next
HEAD = struct.Struct("<4sBQI")
#: Words whose ids a worker remembers.
WORDS = 1_000_000
#: The same in a stage among others, where memory is shared.
FEWER = 200_000
#: Signs that form a piece of their own behind letters (the apostrophe may begin another).
SIGNS = string.punctuation.replace("'", "")


#: Texts that a tokenizer must encode word by word for words to be remembered.
PROBES = ("a b", " two  words ", "line\none", "don't stop, now. (ok) 12 3", "\n\nx\n", "é ß 日本 語", "Hello world-wide web's e.g.")


class Encoder:
    """Encodes texts as the tokenizer does, remembering the ids of words between blanks.

    Only for tokenizers that drop white space and never let a token cross it, which a few probes check; with any other
    one, texts are encoded whole."""

    def __init__(self, path: str, words: int = WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.words = Tokenizer.from_file(path), words
        self.known: dict[str, bytes] = {"": b""}
        mark = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = bool(mark) and token.endswith(mark)
        ids = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        self.by_words = all(ids(t) == [i for w in t.replace("\n", " ").split(" ") for i in ids(w)] for t in PROBES)

    def _learn(self, words: set[str]) -> None:
        known = self.known
        if len(known) + len(words) > self.words:
            known.clear()
            known[""] = b""
        # latin letters with or without a run of signs behind them: two pieces, the ids of the lower-case letters and those of the signs
        full, cores, signs, rest = [], [], [], []
        for w in words:
            core = w.rstrip(SIGNS)
            if core.isalpha() and (core.isascii() or max(core) < "İ"):
                full.append(w)
                cores.append(core.lower())
                signs.append(w[len(core) :])
            elif w:
                rest.append(w)
        rest += {s for s in signs if s not in known}
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            known[w] = np.array(e.ids, "<u4").tobytes()
        new = [c for c in set(cores) if c not in known]
        for at in range(0, len(new), 128):
            self._learn_joined(new[at : at + 128])
        known.update((w, known[c] + known[s]) for w, c, s in zip(full, cores, signs, strict=True) if s or w != c)

    def _learn_joined(self, words: list[str]) -> None:
        """Words of letters only: each is one piece, so in a joined text each ends with one token that ends a word."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words):  # not so with this tokenizer
            for w, e in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False), strict=True):
                self.known[w] = np.array(e.ids, "<u4").tobytes()
            return
        blob, start = ids.tobytes(), 0
        for w, end in zip(words, (ends * 4).tolist(), strict=True):
            self.known[w] = blob[start:end]
            start = end

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_words:
            return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
        out = []
        parts = [(t or "").replace("\n", " ").split(" ") for t in texts]
        get = self.known.get
        found = [list(map(get, p)) for p in parts]
        missing = [[i for i, x in enumerate(f) if x is None] for f in found]
        new = {p[i] for p, m in zip(parts, missing, strict=True) for i in m}
        if new:
            self._learn(new)
        for p, f, m in zip(parts, found, missing, strict=True):
            for i in m:
                f[i] = get(p[i])
            out.append(np.frombuffer(b"".join(f), "<u4"))
        return out


def pack(doc_ids: np.ndarray, lengths: np.ndarray, tokens: np.ndarray) -> bytes:
    """A shard of the given documents, whose tokens follow each other."""
    n, bits = len(tokens), max(1, int(tokens.max(initial=0)).bit_length())
    out = [HEAD.pack(b"WVM1", bits, n, len(doc_ids)), doc_ids.astype("<i8").tobytes(), lengths.astype("<u4").tobytes()]
    v = tokens.astype(np.uint16 if bits <= 16 else np.uint32)
    for level in range(bits - 1, -1, -1):
        bit = (v >> level) & 1 != 0
        plane = np.packbits(bit, bitorder="little")
        whole = np.zeros(-(-n // SAMPLE) * SAMPLE // 8, np.uint8)
        whole[: len(plane)] = plane
        ranks = np.zeros(len(whole) * 8 // SAMPLE + 1, "<u4")
        np.cumsum(np.bitwise_count(whole.view(np.uint64)).reshape(-1, SAMPLE // 64).sum(axis=1), out=ranks[1:])
        out += [whole.tobytes(), ranks.tobytes()]
        v = np.concatenate([v[~bit], v[bit]])
    return b"".join(out)


class Shard:
    """Reads one shard; positions count the shard's tokens from 0."""

    def __init__(self, blob: bytes):
        magic, self.bits, self.n, docs = HEAD.unpack_from(blob)
        if magic != b"WVM1":
            raise ValueError("not a shard")
        at = HEAD.size
        self.doc_ids = np.frombuffer(blob, "<i8", docs, at)
        self.lengths = np.frombuffer(blob, "<u4", docs, at + 8 * docs)
        at += 12 * docs
        blocks = -(-self.n // SAMPLE)
        self.planes, self.ranks = [], []
        for _ in range(self.bits):
            self.planes.append(np.frombuffer(blob, np.uint8, blocks * SAMPLE // 8, at))
            at += blocks * SAMPLE // 8
            self.ranks.append(np.frombuffer(blob, "<u4", blocks + 1, at))
            at += 4 * (blocks + 1)
        self.zeros = [self.n - int(r[-1]) for r in self.ranks]

    def _ones(self, level: int, i: int) -> int:
        """Set bits of a plane before position i."""
        block = i // SAMPLE
        start = block * SAMPLE // 8
        rest = np.unpackbits(self.planes[level][start : start + SAMPLE // 8], bitorder="little")[: i - block * SAMPLE]
        return int(self.ranks[level][block]) + int(rest.sum())

    def access(self, i: int) -> int:
        value = 0
        for level in range(self.bits):
            bit = self.planes[level][i >> 3] >> (i & 7) & 1
            ones = self._ones(level, i)
            value = value << 1 | int(bit)
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def rank(self, token: int, i: int) -> int:
        """Occurrences of the token before position i."""
        return max(0, np.subtract(*self._range(token, i)[::-1]))

    def _range(self, token: int, i: int) -> tuple[int, int]:
        if token >> self.bits:
            return 0, 0
        lo, hi = 0, i
        for level in range(self.bits):
            a, b = self._ones(level, lo), self._ones(level, hi)
            if token >> (self.bits - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence, k from 0; -1 if there are fewer."""
        lo, hi = self._range(token, self.n)
        if k >= hi - lo:
            return -1
        i = lo + k
        for level in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - level) & 1
            want = i - self.zeros[level] if bit else i  # the number of such bits before it
            # among samples, then within one block
            counts = self.ranks[level].astype(np.int64)
            if not bit:
                counts = np.minimum(np.arange(len(counts)) * SAMPLE, self.n) - counts
            block = int(np.searchsorted(counts, want, "right")) - 1
            start = block * SAMPLE // 8
            inside = np.unpackbits(self.planes[level][start : start + SAMPLE // 8], bitorder="little")
            i = block * SAMPLE + int(np.flatnonzero(inside == bit)[want - int(counts[block])])
        return i

    def tokens(self) -> np.ndarray:
        """All tokens, from the lowest plane up: each plane's order is restored from that of the one below it."""
        v = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for level in range(self.bits - 1, -1, -1):
            bit = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            up = np.empty_like(v)
            up[~bit] = v[: self.zeros[level]]
            up[bit] = v[self.zeros[level] :] | (1 << (self.bits - 1 - level))
            v = up
        return v


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def _encoder(path: str, words: int = WORDS) -> Encoder:
    if (path, words) not in _ENCODERS:
        _ENCODERS[path, words] = Encoder(path, words)
    return _ENCODERS[path, words]


def write_shards(docs: DataFrame, tokenizer: str, end_id: int = 1, key: str = "doc_id", text: str = "text", partitions: int | None = None) -> DataFrame:
    """Encodes docs and writes their shards to the shared folder; returns the shard table (part, shard, n_tokens, payload) as read back.

    (part, shard) orders the shards as the ids do. One document never spans two shards."""
    # as many parts as the input has at least, which grows with its bytes
    n = partitions or max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    dealt = docs.withColumn("tie", F.xxhash64("text")).repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def shards(batches):
        encode, part, shard = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        ids, lengths, tokens, size = [], [], [], 0

        def close():
            nonlocal shard, ids, lengths, tokens, size
            blob = pack(np.array(ids, np.int64), np.array(lengths), np.concatenate(tokens))
            out = pa.RecordBatch.from_pydict({"part": [part], "shard": [shard], "n_tokens": [size], "payload": [blob]}, _SHARDS)
            shard, ids, lengths, tokens, size = shard + 1, [], [], [], 0
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                for doc, t in zip(rows.column(0).to_pylist(), encode(rows.column(1).to_pylist()), strict=True):
                    ids.append(_NULL if doc is None else doc)
                    lengths.append(len(t) + 1)
                    tokens += [t, np.array([end_id], "<u4")]
                    size += len(t) + 1
                    if size >= SHARD:
                        yield close()
        if ids:
            yield close()

    return staged(dealt.mapInArrow(shards, "part int, shard int, n_tokens long, payload binary"), "shards")


def encoded(docs: DataFrame, tokenizer: str, end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_tokens and ids, the end id included."""

    def encode_all(batches):
        encode = _encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                ids = [np.append(t, end_id).astype(np.int32) for t in encode(rows.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([len(t) for t in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "n_tokens", "ids"])

    return docs.select(F.col(key).alias("doc_id"), text).mapInArrow(encode_all, f"doc_id {docs.schema[key].dataType.simpleString()}, n_tokens long, ids array<int>")


def lengths(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", lean: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens. The end id counts, as in the shards' lengths, so an empty text has one token.

    lean: for a stage among others; a worker gives back what earlier ones left, and remembers FEWER words."""

    def count(batches):
        if lean:
            trimmed()
        encode = _encoder(tokenizer, FEWER if lean else WORDS)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                n = [len(t) + 1 for t in encode(rows.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])

    return docs.select(F.col(key).alias("doc_id"), text).mapInArrow(count, f"doc_id {docs.schema[key].dataType.simpleString()}, n_tokens long")


_NULL = -(1 << 63)  # stands for a null id in a shard
_SHARDS = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_tokens", pa.int64()), ("payload", pa.binary())])


def read_documents(shards: DataFrame) -> DataFrame:
    """Each document of the shards: doc_id, start (tokens of all documents before it), n_tokens, ids_crc32.

    The running totals are taken over one row per partition, and then within partitions."""
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # one row for each partition of the writer: few at any size
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before_part"))
    before = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    at = shards.select("part", "shard", F.coalesce(before, F.lit(0)).alias("before_shard")).join(parts, "part").select("part", "shard", (F.col("before_part") + F.col("before_shard")).alias("before"))

    def decode(batches):
        for batch in batches:
            for part, no, blob in zip(*(batch.column(i) for i in range(3)), strict=True):
                s = Shard(blob.as_py())
                ids, n = s.tokens().astype("<u4"), s.lengths.astype(np.int64)
                ends = np.cumsum(n)
                crcs = [zlib.crc32(ids[b - k : b]) for b, k in zip(ends, n, strict=True)]
                same = pa.array([part.as_py()] * len(n), pa.int32()), pa.array([no.as_py()] * len(n), pa.int32())
                yield pa.RecordBatch.from_arrays([*same, pa.array([None if x == _NULL else x for x in s.doc_ids.tolist()], pa.int64()), pa.array(ends - n), pa.array(n), pa.array(crcs, pa.int64())], ["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"])

    found = shards.select("part", "shard", "payload").mapInArrow(decode, "part int, shard int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return found.join(at, ["part", "shard"]).select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """How often a token occurs in each shard: part, shard, n. Reads bit-planes; decodes nothing."""

    def look(batches):
        for batch in batches:
            n = [Shard(b.as_py()).count(token) for b in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["part", "shard", "n"])

    return shards.select("part", "shard", "payload").mapInArrow(look, "part int, shard int, n long")
