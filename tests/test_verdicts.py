"""Verdicts are asked for once; failures are tried again, alone, and not for ever."""

from pyspark.sql import functions as F

from trawl.operators import verdicts as V

KEYS, DDL = ["kind", "value"], "good boolean"


def test_classify(spark, tmp_path):
    # inside, so that tasks get the functions themselves
    def answers(prompts):
        if any("bad" in p for p in prompts):
            raise RuntimeError("refused")
        return ["no idea" if "odd" in p else 'Well: {"good": %s}.' % ("true" if "yes" in p else "false") for p in prompts]

    def never(prompts):
        raise AssertionError("asked again")

    path = f"file://{tmp_path}/store"
    rows = [("q", f"v{i}", "yes" if i % 2 else "no", i) for i in range(40)] + [("q", "v1", "no, later", 99), ("q", "b", "bad", 1), ("q", "o", "odd", 2), (None, "n", "yes", 3)]
    leads = spark.createDataFrame(rows, "kind string, value string, evidence string, ord int").repartition(2)
    call = lambda df, ask, version="1", **kw: V.classify_new(df, path, ask, F.concat("value", F.lit(": "), "evidence"), DDL, version, KEYS, [F.col("ord")], batch=8, **kw)
    state = lambda version="1": {(r.kind, r.value): (r.ok, r.verdict.good if r.verdict else None, r.error, r.tries) for r in V.verdicts(spark, path, leads, KEYS, DDL, version).collect()}
    call(leads, answers, budget=10)
    assert len(state()) == 10
    call(leads, answers)
    got = state()
    assert len(got) == 43 and got["q", "v1"] == (True, True, None, 1) and got[None, "n"][:2] == (True, True)
    assert got["q", "b"] == (False, None, "RuntimeError: refused", 2) and got["q", "o"][2] == "no verdict in the answer"
    done = leads.where("value NOT IN ('b', 'o')")
    call(done, never)
    assert state() == got
    call(leads, answers)
    call(leads, never)  # both failures have had their three tries
    assert state()["q", "b"][3] == 3
    call(leads.where("ord < 5"), answers, version="2")
    assert len(state("2")) == 8 and state()["q", "v1"] == (True, True, None, 1)
