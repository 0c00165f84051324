"""Exact top-k inner products with a bit-sliced index.

Components become integers: floor(scale * x). Candidates are dealt by hash into blocks of BLOCK rows; a block's index
row holds, for every attribute, one bitmap over the block's rows per binary digit of the value less the block's
smallest one. The index is built once, by one task for each block, and written to the shared folder. A query weighs each attribute's slices by the digits of its own component (signed digits, so few
are set): the shifted slices are added by carry-save bitmap arithmetic into the slices of the score. The top rows are
then selected from the most significant slice downward; rows that tie at the boundary are resolved exactly, smaller
ids first. Every score is exact, so merging each query's best of all blocks is exact too.

Queries are dealt into chunks of CHUNK, and each (block, chunk) is a task of its own: it reads one index row, of as many bits for each vector as
its components have digits, and streams the chunk's queries past it. So neither the queries nor the rows are ever
in one place, and with n vectors and q queries n * q / CHUNK index entries and q * n / BLOCK queries are sent: one for each
tens of thousands of scores. Where that gives too few tasks for the session, chunks are smaller; the result is the same. Vectors that are null, or hold a null or a component that is not finite, take no part. Vectors of
unequal length: missing components count as zero. Empty vectors score 0. Repeated ids are separate rows, dealt by id and vector; a query never meets its own id.
Components of any finite size are exact: slices and scores have as many digits as the numbers ask for. Rows with a
component of 2 ** WIDE or more after scaling go to blocks of their own, of FEW rows, as their slices are many. Ranks follow
the whole scores; a score beyond 64 bits is given as the nearest long.
An empty table gives an empty result. Only key and vector are read, so other columns' names can't clash.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import staged

BLOCK, CHUNK = 65_536, 16_384
#: Digits from which on rows are indexed apart, and how many of them a block has.
WIDE, FEW = 56, 1_024


def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(attributes x digits x words) bitmaps, the attributes' smallest values, and the number of rows."""
    n, dims = values.shape
    low = values.min(axis=0) if n else np.zeros(dims, np.int64)
    up = values - low
    width = int(up.max()).bit_length() if up.size else 0
    if values.dtype != object:
        up = up.astype(np.uint64)
    words = -(-n // 64)
    out = np.zeros((dims, width, words * 8), np.uint8)
    for j in range(width):
        bits = ((up >> (j if up.dtype == object else np.uint64(j))) & (1 if up.dtype == object else np.uint64(1))).astype(np.uint8)
        out[:, j, : -(-n // 8)] = np.packbits(bits, axis=0, bitorder="little").T
    return out.view(np.uint64), low, n


def digits(value: int) -> list[tuple[int, int]]:
    """The value as a sum of +-2**i with no two neighbouring i: (i, sign)."""
    out, i = [], 0
    while value:
        if value & 1:
            sign = 2 - (value & 3)
            out.append((i, sign))
            value -= sign
        value >>= 1
        i += 1
    return out


def score_slices(slices: np.ndarray, low: np.ndarray, query: np.ndarray) -> tuple[list[np.ndarray], int]:
    """Slices of (score - offset), from the least significant, all scores being >= offset."""
    dims, width, words = slices.shape
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    flat = slices.reshape(dims * width, words)
    # the bitmaps of each weight: rows of flat, and whether they are complemented
    rows: list[list[int]] = []
    flip: list[list[bool]] = []
    offset = 0
    for d in range(min(dims, len(query))):
        q = int(query[d])
        offset += q * int(low[d])
        for i, sign in digits(q):
            # minus 2**i * u is 2**i * (complement of u) less 2**i * (2**width - 1)
            offset -= (2**width - 1 << i) if sign < 0 else 0
            while len(rows) < i + width:
                rows.append([])
                flip.append([])
            for j in range(width):
                rows[i + j].append(d * width + j)
                flip[i + j].append(sign < 0)
    out, at, carried = [], 0, []
    while at < len(rows) or carried:
        parts = carried
        if at < len(rows) and rows[at]:
            parts = [flat[rows[at]] ^ np.where(flip[at], ones, np.uint64(0))[:, None], *carried]
        column = np.concatenate(parts) if parts else np.zeros((0, words), np.uint64)
        carried = []
        while len(column) > 2:  # three bitmaps of one weight -> one of it and one of the next, many at a time
            k = len(column) // 3
            a, b, c = column[:k], column[k : 2 * k], column[2 * k : 3 * k]
            ab = a ^ b
            carried.append((a & b) | (ab & c))
            column = np.concatenate([ab ^ c, column[3 * k :]])
        if len(column) == 2:
            carried.append(column[:1] & column[1:])
            column = column[:1] ^ column[1:]
        out.append(column[0] if len(column) else np.zeros(words, np.uint64))
        at += 1
    return out, offset


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def top_rows(score: list[np.ndarray], alive: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the k highest scores among the alive rows, ties to the smaller row number."""
    sure, maybe, n_sure = np.zeros_like(alive), alive.copy(), 0
    for s in reversed(score):
        x = maybe & s
        n = n_sure + int(np.bitwise_count(x).sum())
        if n > k:
            maybe = x
        else:
            sure, n_sure, maybe = sure | x, n, maybe & ~s
            if n == k:
                return _rows(sure)
    return np.concatenate([_rows(sure), _rows(maybe)[: k - n_sure]])


def value_of(score: list[np.ndarray], rows: np.ndarray, offset: int) -> list[int]:
    word, bit = rows >> 6, (rows & 63).astype(np.uint64)
    out = [offset] * len(rows)
    for i, s in enumerate(score):
        for r in np.flatnonzero((s[word] >> bit) & np.uint64(1)):
            out[r] += 1 << i
    return out


def _whole(x: float, scale: float) -> int:
    """floor(scale * x), also where the product is no double."""
    y = scale * x
    return math.floor(y) if math.isfinite(y) else math.floor(Fraction(x) * Fraction(scale))


def _matrix(column: pd.Series, scale: float) -> np.ndarray:
    """Scaled components as integers: of 64 bits where all are small, else Python's."""
    n = max((len(x) for x in column), default=0)
    out = np.zeros((len(column), n), np.float64)
    for i, x in enumerate(column):
        out[i, : len(x)] = x
    with np.errstate(over="ignore"):
        scaled = np.floor(scale * out)
    if np.abs(scaled).max(initial=0) < 2.0**62:
        return scaled.astype(np.int64)
    return np.array([[_whole(x, scale) for x in row] for row in out.tolist()], object).reshape(out.shape)


def _index(key: tuple, pdf: pd.DataFrame, scale: float) -> pd.DataFrame:
    """One row of a block's index: its ids in order, the attributes' smallest values, and the slices."""
    pdf = pdf.sort_values("id", kind="stable")
    values = _matrix(pdf["v"], scale)
    slices, low, n = slices_of(values)
    return pd.DataFrame({"block": [key[0]], "ids": [pdf["id"].to_numpy(np.int64).tobytes()], "low": [[str(x) for x in low]], "width": [slices.shape[1]], "slices": [slices.tobytes()]})


def _order(score: int) -> str:
    """A text that orders as the scores do, whatever their size."""
    digits = str(abs(score))
    if score >= 0:
        return f"1{len(digits):04d}{digits}"
    return f"0{9999 - len(digits):04d}" + digits.translate(_NINES)


_NINES = str.maketrans("0123456789", "9876543210")


def _search(index: pd.DataFrame, asked: pd.DataFrame, k: int, scale: float) -> pd.DataFrame:
    found = []
    queries = [(q, _matrix(pd.Series([v]), scale)[0]) for q, v in zip(asked["id"], asked["v"], strict=True)]
    for row in index.itertuples():
        ids, low = np.frombuffer(row.ids, np.int64), [int(x) for x in row.low]
        n, dims = len(ids), len(low)
        slices = np.frombuffer(row.slices, np.uint64).reshape(dims, row.width, -1) if dims and row.width else np.zeros((dims, 0, -(-n // 64)), np.uint64)
        everyone = np.zeros(-(-n // 64) * 8, np.uint8)
        everyone[: -(-n // 8)] = np.packbits(np.ones(n, np.uint8), bitorder="little")
        everyone = everyone.view(np.uint64)
        for q, v in queries:
            score, offset = score_slices(slices, low, v)
            alive = everyone
            own = np.arange(np.searchsorted(ids, q, "left"), np.searchsorted(ids, q, "right"))
            if len(own):
                alive = alive.copy()
                np.bitwise_and.at(alive, own >> 6, ~(np.uint64(1) << (own & 63).astype(np.uint64)))
            rows = top_rows(score, alive, k)
            found += [(q, ids[r], min(max(s, -(2**63)), 2**63 - 1), _order(s)) for r, s in zip(rows, value_of(score, rows, offset), strict=True)]
    return pd.DataFrame(found, columns=["query_id", "vec_id", "score", "by"]).astype({"query_id": "int64", "vec_id": "int64", "score": "int64"})


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: int = 64, vec: str = "embedding", key: str = "vec_id") -> DataFrame:
    """Each query's k best rows of vectors: query_id, rank (from 1), vec_id, score. queries has the same columns."""

    def whole(df: DataFrame) -> DataFrame:
        fit = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        wide = F.exists("v", lambda x: F.abs(x) >= 2.0**WIDE / scale)
        return df.where(F.col(key).isNotNull() & F.col(vec).isNotNull() & fit).select(F.col(key).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("v")).withColumn("wide", wide)

    vectors, queries = whole(vectors), whole(queries)
    n_rows, n_wide = vectors.agg(F.count("*"), F.count_if("wide")).first()
    n_queries = queries.count()
    plain, apart = max(1, math.ceil((n_rows - n_wide) / BLOCK)), math.ceil(n_wide / FEW)
    blocks = plain + apart
    busy = 2 * vectors.sparkSession.sparkContext.defaultParallelism
    chunks = max(1, math.ceil(n_queries / CHUNK), min(math.ceil(busy / blocks), math.ceil(n_queries / 64)))
    deal = lambda n: F.pmod(F.xxhash64("id", "v"), F.lit(max(1, n))).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = vectors.select("id", "v", F.when(F.col("wide"), deal(apart) + plain).otherwise(deal(plain)).alias("block"))
    index = index.groupBy("block").applyInPandas(lambda key, pdf: _index(key, pdf, float(scale)), "block int, ids binary, low array<string>, width int, slices binary")
    index = staged(index, "slices").select("*", spread(chunks).alias("chunk"))
    asked = queries.select("id", "v", deal(chunks).alias("chunk")).select("*", spread(blocks).alias("block"))
    found = index.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk")).applyInPandas(lambda a, b: _search(a, b, k, float(scale)), "query_id long, vec_id long, score long, by string")
    best = Window.partitionBy("query_id").orderBy(F.desc("by"), "vec_id")
    return found.select("*", F.row_number().over(best).alias("rank")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
