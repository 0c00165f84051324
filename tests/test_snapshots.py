"""Versions with one site of all captures, spread over partitions, against a plain loop."""

import random

import pytest

from trawl.operators import order as O
from trawl.operators import snapshots as S


@pytest.mark.parametrize("sites,hashes", [(1, 3), (1, 200), (4, 2), (60, 5)])
def test_versions(spark, sites, hashes):
    r = random.Random(sites * hashes)
    rows = [(f"s{r.randrange(sites)}", i, r.choice([None, *[str(h) for h in range(hashes)]])) for i in range(500)]
    df = spark.createDataFrame(r.sample(rows, len(rows)), "site_id string, ord long, sha string").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert sites > 1 or O.dealt(df, ["site_id"], [df.ord]).select(O.PART).distinct().count() > 5
        got = {(x.site_id, x.ord): (x.prev_sha, x.is_new, x.ver, x.flap) for x in S.versions(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    state = {}
    for site, ord_, sha in rows:
        prev, ver, seen, first = state.get(site, (None, 0, set(), True))
        new = first or sha != prev
        assert got[site, ord_] == (prev, int(new), ver + new, new and sha in seen)
        state[site] = (sha, ver + new, seen | ({sha} if new else set()), False)
    assert len(got) == len(rows)
