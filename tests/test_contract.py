"""Lines of all layouts, their violations and grades; the ladder of evidence."""

import json

import pytest

from trawl.operators import contract as K

GOOD = {"schema": "r3-audit-v2", "ts_epoch": 1767225600.5, "ts_iso": "2026-01-01T00:00:01Z", "pid": 7, "writer": "retry", "seq": 1, "level": "request", "event": "retry_scheduled", "detail": {"n": 1}, "run": "r1"}
DROP = object()


def changed(**kw):
    return {k: v for k, v in {**GOOD, **kw}.items() if v is not DROP}


CASES = [
    ({}, []), ({"ts_epoch": "1767225600"}, ["ts_epoch_missing_or_not_number"]), ({"ts_epoch": True}, ["ts_epoch_missing_or_not_number"]), ({"ts_epoch": 5, "ts_iso": "1970-01-01T00:00:05Z"}, ["ts_implausible"]),
    ({"ts_epoch": 1767229000, "ts_iso": "2026-01-01T00:56:40Z"}, ["ts_in_future"]), ({"ts": 1}, ["legacy_ts_key"]), ({"ts_iso": " "}, ["ts_iso_missing"]), ({"ts_iso": "soon"}, ["ts_iso_unparsable"]), ({"ts_iso": "2026-01-01T00:01:00Z"}, ["ts_iso_mismatch"]),
    ({"pid": "7"}, ["pid_missing_or_not_int"]), ({"pid": DROP}, ["pid_missing_or_not_int"]), ({"writer": ""}, ["writer_missing"]), ({"seq": 0}, ["seq_not_positive"]), ({"seq": 1.5}, ["seq_missing_or_not_int"]), ({"level": "odd"}, ["level_not_in_enum"]),
    ({"level": "block"}, ["event_level_mismatch"]), ({"event": "what"}, ["event_unknown"]), ({"event": ""}, ["event_missing"]), ({"event": DROP, "detail": None}, ["event_missing", "detail_missing"]), ({"detail": "x"}, ["detail_not_object"]), ({"event": "run_start", "level": "process"}, []),
]


def test_issues(spark):
    rows = [(i, json.dumps(changed(**c))) for i, (c, _) in enumerate(CASES)]
    got = {r.i: r.issues for r in K.read(spark.createDataFrame(rows, "i int, value string"), now=1767225700).collect()}
    assert got == {i: want for i, (_, want) in enumerate(CASES)}


def test_layouts_and_modes(spark):
    lines = [
        ("a", json.dumps({"schema": "keeper-audit-v1", "ts": "2026-01-02T00:00:00Z", "keeper_pid": 9, "seq": 3, "level": "process", "r3_event": "restart", "event": "x", "evidence": {"k": 1}, "run_id": "q"}), True),
        ("b", json.dumps({"ts": 1767225600, "event": "trim", "pid": 4}), True), ("c", json.dumps({"ts": 1, "event": "level-up", "level": 3}), False), ("d", "not json", True), ("e", "[1]", True), ("f", None, True),
    ]
    df = spark.createDataFrame(lines, "k string, value string, sure boolean")
    got = {r.k: (r.rec.layout, r.rec.event, r.rec.pid, r.rec.ts, r.issues) for r in K.read(df, authoritative="sure").collect()}
    assert got["a"] == ("keeper", "keeper_restart", 9, 1767312000.0, ["legacy_layout", "ts_epoch_missing_or_not_number", "legacy_ts_key"])
    assert got["c"] == ("aux", "mem_level_change", None, 1.0, ["aux_level_type_conflict"]) and all(got[k][0] == "bad" and got[k][4] == [] for k in "def")
    got = {r.k: (r.rec.layout, r.rec.event, r.rec.detail, r.rec.run, r.issues) for r in K.read(df, K.Contract(compat=True), authoritative="sure").collect()}
    assert got["a"] == ("keeper", "keeper_restart", '{"k":1}', "q", []) and got["b"] == ("canonical-v1", "mem_abort", "{}", None, ["legacy_field_missing:seq", "legacy_field_missing:level"])


@pytest.mark.parametrize("contract,want", [(K.Contract(), "soft hard hard soft hard"), (K.Contract(compat=True), "soft soft soft soft hard"), (K.Contract(strict_aux=True), "soft hard hard hard hard")])
def test_severity(spark, contract, want):
    rows = [(0, "v2", "event_unknown"), (1, "v2", "writer_missing"), (2, "keeper", "legacy_layout"), (3, "aux", "aux_level_type_conflict"), (4, "v2", "seq_not_positive")]
    df = spark.createDataFrame(rows, "i int, layout string, kind string")
    assert [r.s for r in df.select("i", K.severity(df.layout, df.kind, contract).alias("s")).orderBy("i").collect()] == want.split()


def test_derived_and_verdicts(spark):
    facts = spark.createDataFrame([("r", "log", "a", 5), ("r", "log", "b", 2), ("s", "log", "a", 9), ("t", "progress", "p", 1)], "run string, channel string, key string, n int")
    specs = spark.createDataFrame([("c1", 1, "log", "a", 3, 1), ("c2", 1, "log", "a", 1, 2), ("c2", 1, "log", "b", 2, 2), ("c3", 1, "progress", "p", 2, 1)], "check string, item int, channel string, key string, at_least int, need int")
    sources = spark.createDataFrame([("r", True), ("s", False)], "run string, source_ok boolean")
    got = {(x.run, x.check): (x.derived_ok, x.hits, x.rejects) for x in K.derived(facts, specs, sources).collect()}
    assert got == {("r", "c1"): (True, 1, 0), ("r", "c2"): (True, 1, 0), ("s", "c1"): (False, 0, 1)}

    runs = spark.createDataFrame([(r, h, v, o, True, w) for r, h, v, o, w in [("a", 0, 5, 0, False), ("b", 0, 5, 0, False), ("c", 0, 5, 1, False), ("d", 1, 5, 0, False), ("e", 0, 5, 0, True)]], "run string, hard int, v2_records int, legacy_records int, window_enforced boolean, writerless boolean")
    checks = [("a", True, False), ("a", True, True), ("b", True, False), ("b", False, True), ("c", False, True), ("d", True, False), ("d", False, False), ("e", True, False)]
    checks = spark.createDataFrame([(r, f"k{i}", True, a, d) for i, (r, a, d) in enumerate(checks)], "run string, check string, windowed boolean, audit_ok boolean, derived_ok boolean")
    got = {x.run: (x.passed, x.canonical_pass, x.channel, x.evidence_level, x.degraded, x.missing) for x in K.verify(runs, checks, compat=True).collect()}
    assert got == {
        "a": (True, True, "audit", "high", [], []), "b": (True, False, "mixed", "low", ["derived_only:k3"], []), "c": (True, False, "derived", "low", ["compat_v1_layout", "derived_only", "derived_only:k4"], []),
        "d": (False, False, "mixed", "low", [], ["k6"]), "e": (True, False, "audit", "low", ["compat_v1_seq_grouping_by_pid"], []),
    }
