"""Sliding order statistics and the frozen baseline against a plain loop."""

import random

import pytest

from trawl.operators import sliding as S


def at(values, q):
    s = sorted(values)
    return s[min(len(s) - 1, int(len(s) * q))]


def loop(samples):
    out, base, seen = {}, None, []
    for i, v in samples:
        seen.append(v)
        recent, cand = seen[-30:], at(seen[-256:], 0.1)
        p50 = at(recent, 0.5)
        if not (len(recent) >= 30 and p50 and cand > 0 and p50 / cand >= 1.5):
            base = cand
        now = cand if base is None else base
        ratio = p50 / now if len(recent) >= 30 and now > 0 else None
        out[i] = (p50, cand, now, ratio, min(1.5, ratio / 1.8) - 1 if ratio is not None and ratio >= 1.8 else 0.0)
    return out


@pytest.mark.parametrize("block", [64, 300, 8192])
def test_latency_rise(spark, block):
    """One class has nearly all samples and slows down: its baseline stays while the candidate moves."""
    r = random.Random(block)
    slow = lambda i: 5.0 if 700 <= i < 1100 else 1.0
    hot = [(i, round(slow(i) * r.uniform(0.9, 1.1), 4)) for i in range(1500)]
    cold = [(5000 + i, r.choice([0.0, 1.0, 3.0])) for i in range(70)]
    rows = [("hot", *x) for x in hot] + [("cold", *x) for x in cold]
    df = spark.createDataFrame(r.sample(rows, len(rows)), "k string, i long, v double")
    got = {x.i: (x.p50, x.cand, x.base, x.ratio, x.rise) for x in S.latency_rise(df, "k", ["i"], "v", block, 7).collect()}
    want = loop(hot) | loop(cold)
    assert got.keys() == want.keys()
    for i, w in want.items():
        assert got[i][:3] == w[:3] and got[i][3] == pytest.approx(w[3]) and got[i][4] == pytest.approx(w[4]), i
    frozen = [i for i in range(720, 925) if got[i][2] != got[i][1]]
    assert len(frozen) > 50 and len({got[i][2] for i in range(720, 925)}) == 1 and all(got[i][4] == 0.5 for i in range(730, 925))


def test_empty(spark):
    assert S.latency_rise(spark.createDataFrame([], "k string, i long, v double"), "k", ["i"], "v").collect() == []
