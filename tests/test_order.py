"""Ranks and running values over range partitions, with one group of all rows and with many."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from trawl.operators import order as O


def rows(groups):
    r = random.Random(len(groups))
    keys = list(range(400))
    r.shuffle(keys)
    return [(r.choice(groups), k, r.choice([None, 1, 2, 5]), r.choice("aab")) for k in keys]


CASES = [["one"], ["x", "y", None], [str(i) for i in range(300)]]


@pytest.mark.parametrize("groups", CASES)
def test_ranked(spark, groups):
    data = rows(groups)
    df = spark.createDataFrame(data, "g string, k int, v int, s string").repartition(5)
    got = {(r.g, r.k): (r.rn, r.n) for r in O.ranked(df, ["g"], [F.col("k").desc()], size="n", partitions=7).collect()}
    for g, members in itertools.groupby(sorted(data, key=lambda r: (str(r[0]), -r[1])), key=lambda r: r[0]):
        members = list(members)
        assert [got[g, m[1]] for m in members] == [(i + 1, len(members)) for i in range(len(members))]


@pytest.mark.parametrize("groups", CASES)
def test_scan(spark, groups):
    data = rows(groups)
    df = spark.createDataFrame(data, "g string, k int, v int, s string").repartition(3)
    d = O.dealt(df, ["g"], [F.col("k")], 9)
    assert groups != ["one"] or d.select(O.PART).distinct().count() > 5  # one group is spread
    x = O.scan(d, ["g"], sums={"total": F.col("v")}, maxima={"top": F.col("v")}, lags={"prev": F.col("v")}, lasts={"last": F.col("v")})
    x = O.scan(x, ["g"], sums={"twos": (F.col("prev") == 2).cast("int")}).drop(O.PART, O.AT)
    assert x.columns == ["g", "k", "v", "s", "total", "top", "prev", "last", "twos"]
    got = {(r.g, r.k): tuple(r)[4:] for r in x.collect()}
    assert len(got) == len(data)
    for g, members in itertools.groupby(sorted(data, key=lambda r: (str(r[0]), r[1])), key=lambda r: r[0]):
        total, top, prev, last, twos = 0, None, None, None, 0
        for _, k, v, _ in members:
            total += v or 0
            top = max([y for y in (top, v) if y is not None], default=None)
            last = v if v is not None else last
            twos += prev == 2
            assert got[g, k] == (total, top, prev, last, twos)
            prev = v


def test_empty(spark):
    df = spark.createDataFrame([], "g string, k int, v int")
    assert O.ranked(df, ["g"], [F.col("k")]).collect() == []
    assert O.scan(O.dealt(df, ["g"], [F.col("k")]), ["g"], sums={"t": F.col("v")}).collect() == []
    one = O.ranked(spark.createDataFrame([(3,), (1,), (2,)], "k int"), [], [F.col("k")])
    assert sorted(map(tuple, one.collect())) == [(1, 1), (2, 2), (3, 3)]
