"""Language identification by language-bitmask n-gram filters.

A table of slots holds one byte per slot and slice, a slice being four languages: two bits of a slot are set if some
n-gram of language l falls there, and if one that is common in l does. An n-gram has HASHES slots; their bytes joined by AND give all languages that contain it in one lookup, and
those in which it is common: a bit-sliced Bloom filter. A text's bits are counted per language; the count that false positives alone would
give, known from the share of set bits, is taken out; the corrected shares of known and of common n-grams, COMMON_WEIGHS for the latter, decide.

The filters are fitted on a sample of about SAMPLE texts of each language (a documented bound; rows chosen by hash of their key, so that no text
brings more than its share, and equal texts count once). They hold every n-gram of the sample. One that is in one of COMMON texts of its language, or more, is common there: words
quoted in another language are contained in it, but not common. The bits are joined in Spark; the driver gets the table, whose size is fixed.

Null texts and texts without a letter are "und" with score 0. Rows without a language aren't learned from. A text in which no n-gram
is known gets the most frequent language with score 0. Ties go to the language first in alphabetical order. Without any row to learn from, all is "und". Repeated rows are
judged alike; an empty table gives an empty result. Very long texts are read whole. predict() reads key and text only, and accept() keeps all columns, so other columns' names can't clash.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import bounded_fraction, share, staged, trimmed

N, HASHES, SLOTS = 5, 2, 1 << 21
SAMPLE, COMMON, COMMON_WEIGHS = 1_500, 100, 0.75
_LETTER = re.compile(r"[^\W\d_]")
_BLANK = bytes(c if c > 127 or 97 <= c <= 122 else 32 for c in range(256))
_CUT = np.uint64((1 << 8 * N) - 1)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def grams(text: str) -> np.ndarray:
    """The byte n-grams of a text's lower-case letters, words being parted by blanks."""
    b = b" " + text.lower().encode("utf-8", "surrogatepass").translate(_BLANK) + b" "
    n = max(1, len(b) - N + 1)
    return np.ndarray((n,), "<u8", b + bytes(8 + N), strides=(1,)) & _CUT


def slots(g: np.ndarray) -> list[np.ndarray]:
    shift = np.uint64(64 - SLOTS.bit_length() + 1)
    return [(g * m) >> shift for m in _MIX[:HASHES]]


class Filters:
    """languages: their names in order; slices: bytes by slot, of four languages each; prior: the language of unknown texts."""

    def __init__(self, languages: list[str], slices: list[np.ndarray], prior: str):
        self.languages, self.slices, self.prior = languages, slices, prior
        self.bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
        full = np.concatenate([np.bincount(s, minlength=256) @ self.bits for s in slices]) if slices else np.zeros(0)
        self.false = (full[: 2 * len(languages)] / SLOTS) ** HASHES

    def shares(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The corrected shares of the text's n-grams that each language contains, and that are common in it."""
        g = grams(text)
        at = slots(g)
        found = []
        for s in self.slices:
            mask = s[at[0]]
            for a in at[1:]:
                mask = mask & s[a]
            found.append(np.bincount(mask, minlength=256) @ self.bits)
        seen = np.concatenate(found)[: 2 * len(self.languages)] / len(g)
        seen = np.clip((seen - self.false) / (1 - self.false), 0, 1)
        return seen[::2], seen[1::2]

    def judge(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, share of n-grams common in it). The score is the language's part of all shares."""
        if text is None or not self.languages or not _LETTER.search(text):
            return "und", 0.0, 0.0
        known, common = self.shares(text)
        s = (1 - COMMON_WEIGHS) * known + COMMON_WEIGHS * common
        best = int(s.argmax())
        if s[best] <= 0:
            return self.prior, 0.0, 0.0
        return self.languages[best], float(s[best] / s.sum()), float(common[best])


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Filters:
    """Filters from the rows of docs that have a text and a language."""
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    counts = {r.lang: r["count"] for r in docs.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return Filters([], [], "und")
    number = F.lit(None).cast("int")
    chosen = F.lit(False)
    for i, l in enumerate(languages):
        is_l = F.col("lang") == l
        chosen = chosen | (is_l & share(F.coalesce(F.col("key").cast("string"), F.lit("")), bounded_fraction(counts[l], SAMPLE)))
        number = F.when(is_l, i).otherwise(number)
    sample = staged(docs.where(chosen).select("text", number.cast("int").alias("language")).distinct(), "sample")
    sizes = {r.language: r["count"] for r in sample.groupBy("language").count().collect()}

    def explode(batches):
        for batch in batches:
            parts = [np.unique(grams(t)).view(np.int64) for t in batch.column(0).to_pylist()]
            n = [len(p) for p in parts]
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(1).to_numpy(zero_copy_only=False), n), pa.int32()), pa.array(np.concatenate(parts))], ["language", "gram"])

    def place(batches):
        least = np.array([max(2, -(-sizes.get(i, 0) // COMMON)) for i in range(len(languages))])
        for batch in batches:
            language, gram, count = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            bits = (1 + 2 * (count >= least[language])) << 2 * (language % 4)
            at = np.concatenate(slots(gram.view(np.uint64))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(language // 4, HASHES), pa.int32()), pa.array(at), pa.array(np.tile(bits, HASHES), pa.int32())], ["slice", "slot", "bits"])

    rows = sample.mapInArrow(explode, "language int, gram long").groupBy("language", "gram").count()
    # one row at most for each slice and slot
    table = rows.mapInArrow(place, "slice int, slot long, bits int").groupBy("slice", "slot").agg(F.bit_or("bits").cast("short").alias("bits")).toArrow()
    slices = [np.zeros(SLOTS, np.uint8) for _ in range(-(-len(languages) // 4))]
    which, at, bits = (c.to_numpy() for c in table.columns)
    for i, s in enumerate(slices):
        s[at[which == i]] = bits[which == i].astype(np.uint8)
    return Filters(languages, slices, min(counts, key=lambda l: (-counts[l], l)))


def predict(docs: DataFrame, filters: Filters, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, lang_pred, score, known (share of the text's n-grams that are common in the language)."""
    sent = docs.sparkSession.sparkContext.broadcast(filters)
    kind = docs.schema[key].dataType.simpleString()

    def judge(batches):
        f = sent.value
        for batch in batches:
            out = [f.judge(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64()), pa.array([o[2] for o in out], pa.float64())], ["doc_id", "lang_pred", "score", "known"])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(judge, f"doc_id {kind}, lang_pred string, score double, known double")


def accept(docs: DataFrame, filters: Filters, least_score: float = 0.3, least_known: float = 0.1, text: str = "text") -> DataFrame:
    """The rows of docs, with their columns, whose text is in a known language: not "und", and neither score nor known share too low."""
    sent = docs.sparkSession.sparkContext.broadcast(filters)
    at = docs.columns.index(text)

    def keep(batches):
        trimmed()
        f = sent.value
        for batch in batches:
            out = [f.judge(t) for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array([o[0] != "und" and o[1] >= least_score and o[2] >= least_known for o in out], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
