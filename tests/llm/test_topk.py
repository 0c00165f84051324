import math
import random
from fractions import Fraction

import pytest

from trawl.llm import topk


def brute(rows, k):
    rows = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in rows:
        if q % 20 == 0:
            best = sorted(((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in rows if i != q))[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    return out


@pytest.mark.parametrize("k", [1, 5, 500])
def test_against_brute_force(spark, monkeypatch, k):
    rnd = random.Random(1)
    rows = [(i, [rnd.gauss(0, 0.3) for _ in range(7)]) for i in range(180)]
    rows += [(200 + i, rows[20][1]) for i in range(40)]  # ties
    rows += [(300, None), (320, [None] * 7), (340, [float("nan")] * 7), (360, [float("inf")] * 7), (380, [0.0] * 7), (400, [1.5, -2.0]), (420, [1e6] * 7)]
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "CHUNK", 3)
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, id int, block int")
    got = {tuple(r) for r in topk.top_k(df, df.where("vec_id % 20 = 0"), k).collect()}
    assert got == brute(rows, k)


def test_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(none, none).count() == 0


def test_components_of_any_size(spark):
    """Exact ranks beside components far beyond 64 bits, with repeated and null ids."""
    r = random.Random(3)
    rows = [(i, [r.gauss(0, 1), r.choice([1e20, -1e20, 1e300, 2.0**55, 0.5, 0.25]), r.gauss(0, 1e6)]) for i in range(60)]
    rows += [(20, [1.0, 2.0, 3.0]), (20, [1e20, 1.0, 1.0]), (7, [0.1, 0.1, 0.1]), (None, [1e25, 1.0, 1.0]), (61, [5e-324, -1.7e308, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted((x.query_id, x.rank, x.vec_id, x.score) for x in topk.top_k(df, df.where("vec_id % 20 = 0"), 200).collect())
    whole = [(i, [math.floor(Fraction(x) * 64) for x in v]) for i, v in rows if i is not None]
    scores = {}
    for q, a in whole:
        if q % 20 == 0:
            scores.setdefault(q, []).extend((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole if i != q)
    want = [(q, n + 1, i, min(max(-s, -(2**63)), 2**63 - 1)) for q, found in scores.items() for n, (s, i) in enumerate(sorted(found)[:200])]
    assert got == sorted(want)


def test_order():
    values = sorted(random.Random(1).sample(range(-1000, 1000), 500) + [10**300, -(10**300), 2**63, -(2**63)])
    assert sorted(values, key=topk._order) == values


def test_digits():
    for v in [*range(-70, 70), 12345, -999]:
        d = topk.digits(v)
        assert sum(s << i for i, s in d) == v and all(b - a > 1 for (a, _), (b, _) in zip(d, d[1:], strict=False))
