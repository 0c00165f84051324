import random

from pyspark.sql import functions as F

from trawl.operators import health as H
from trawl.plans import health as P
from trawl.streaming import jobs


def transitions(rows):
    """The breaker's rules restated: five counted failures open it, a success after the cooldown closes it, fatal changes nothing."""
    out, state, n, until = [], "closed", 0, 0
    for o, t, cls in rows:
        if state == "open":
            if t < until:
                continue
            out.append((o, "open", "half_open"))
            state = "half_open"
        if cls == "ok":
            n = 0
            if state == "half_open":
                out.append((o, "half_open", "closed"))
                state = "closed"
        elif cls in ("transient", "limited", "blocked"):
            n += 1
            if state == "half_open" or n >= 5:
                out.append((o, state, "open"))
                state, until = "open", t + (180 if cls == "blocked" else 120)
    return out


def rows(seed, n=400):
    rnd = random.Random(seed)
    return [(i, float(i * rnd.randint(10, 12)), rnd.choice(["ok", "transient", "transient", "limited", "blocked", "fatal", "unknown"])) for i in range(n)]


def test_breaker_batch(spark):
    data = {d: sorted(rows(d), key=lambda r: (r[1], r[0])) for d in (1, 2)}
    df = spark.createDataFrame([(d, *r) for d, rs in data.items() for r in rs], "domain long, ord long, t double, cls string")
    got = sorted((r.domain, r.ord, r.state_from, r.state_to) for r in H.breaker(df).collect())
    assert got == sorted((d, *x) for d, rs in data.items() for x in transitions(rs))
    fatal = spark.createDataFrame([(1, i, float(i), "fatal") for i in range(30)], "domain long, ord long, t double, cls string")
    assert H.breaker(fatal).count() == 0 and H.breaker(df.limit(0)).count() == 0


def test_breaker_stream_equals_batch(spark, tmp_path):
    data = sorted(rows(3), key=lambda r: (r[1], r[0]))
    schema = "domain long, ord long, t double, cls string"
    for i in range(4):  # four files, read one at a time
        spark.createDataFrame([(7, *r) for r in data[i * 100 : i * 100 + 100]], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got = jobs.run(jobs.breaker(stream), "test-breaker").collect()
    assert sorted((r.ord, r.state_from, r.state_to) for r in got) == sorted(transitions(data))


def test_limiter(spark):
    df = spark.createDataFrame([(1, i, float(i), c) for i, c in enumerate(["ok", "limited", "blocked", "ok", "fatal", "ok"] + ["limited"] * 6 + ["ok"] * 40)], "domain long, ord long, t double, cls string")
    got = [(r.interval_from, r.interval_to) for r in H.limiter(df).orderBy("ord").collect()]
    assert got[:4] == [(2.5, 5.0), (5.0, 10.0), (10.0, 9.0), (9.0, 8.1)] and max(b for _, b in got) == 60.0 and got[-1][1] == 2.5


def test_stall_alarm_once(spark, tmp_path):
    data = [(1, 0.0, 5), (1, 500.0, 5), (1, 901.0, 5), (1, 1500.0, 5), (1, 1600.0, 6), (1, 1700.0, 6), (2, 0.0, 1), (2, 899.0, 1)]
    data = [(run, 1e6 + t, mark) for run, t, mark in data]  # rows at the epoch itself are late for any watermark
    spark.createDataFrame(data, "run long, t double, mark long").coalesce(1).write.parquet(f"{tmp_path}/in")
    s = spark.readStream.schema("run long, t double, mark long").parquet(f"{tmp_path}/in")
    got = jobs.run(jobs.stall_alarms(s, 900), "test-stalls", rocks=True).orderBy("t", "run").collect()
    # run 2 falls silent: its alarm comes by timer, once; alarms have the time at which the limit was reached, however the rows were batched
    want = [(1, 1e6 + 900, "stall_detected"), (2, 1e6 + 900, "stall_detected"), (1, 1e6 + 1600, "stall_cleared")]
    assert [(r.run, r.t, r.event) for r in got] == want
    for i in range(0, len(data), 3):
        spark.createDataFrame(sorted(data, key=lambda r: r[1])[i : i + 3], "run long, t double, mark long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/many")
    s = spark.readStream.schema("run long, t double, mark long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/many")
    got = jobs.run(jobs.stall_alarms(s, 900), "test-stalls", rocks=True).orderBy("t", "run").collect()
    assert [(r.run, r.t, r.event) for r in got] == want


def test_state_goes_when_sessions_close(spark, tmp_path):
    """Sessions are written once, when they are over, and their state is dropped."""
    for i in range(6):
        spark.createDataFrame([(u, 1e6 + i * 10_000.0 + k) for u in range(20) for k in range(3)], "u long, t double").select("u", F.timestamp_seconds("t").alias("ts")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    s = spark.readStream.schema("u long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    out = jobs.sessions(s, "ts", "u", "10 minutes", "1 minute").select("u", "n")
    q = out.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start(f"{tmp_path}/out")
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").groupBy("n").count().collect() == [(3, 100)]
    state = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    assert state[-1]["numRowsTotal"] == 20 and sum(x["numRowsRemoved"] for x in state) == 100


def test_versions_go_on_between_batches(spark, tmp_path):
    """baseline, unchanged, changed, back again; two batches give what one gives."""
    one = [("a", 1, "x"), ("a", 2, "x"), ("a", 3, "y"), ("b", 1, "p")]
    two = [("a", 4, "y"), ("a", 5, "x"), ("c", 1, "q"), ("b", 2, "p")]
    path = f"file://{tmp_path}/v"
    for b in (one, two):
        jobs.versions_into(spark.createDataFrame(b, "site_id string, ord long, sha string"), 0, path)
    got = sorted((r.site_id, r.ver, r.sha) for r in spark.read.parquet(path).collect())
    assert got == [("a", 1, "x"), ("a", 2, "y"), ("a", 3, "x"), ("b", 1, "p"), ("c", 1, "q")]


def test_watermarks(spark):
    df = spark.createDataFrame([(1, i, a, 0, float(t)) for i, (a, t) in enumerate([(5, 10), (7, 20), (6, 30), (6, 40), (8, 50), (7, 60)])], "run long, i long, leaves long, records long, t double")
    got = H.watermarks(df, "run", ["i"], "leaves", "records", "t").orderBy("i").collect()
    assert [r.wm_leaves for r in got] == [5, 7, 7, 7, 8, 8]
    assert [r.clamp_episode for r in got] == [0, 0, 1, 2, 0, 1]
    assert [r.first_clamp_t for r in got] == [None, None, 30, 30, None, 60]
    assert [r.wm_t for r in got] == [10, 20, 20, 20, 50, 50] and got[-1].advance_count == 3


def test_heartbeat_order(spark):
    h = spark.createDataFrame([("a", "run", 900, 200, True, 0, False, 0), ("b", "run", 899, 200, True, 0, False, 0), ("c", "run", 900, 10, True, 0, False, 0), ("d", "run", 900, 200, True, 300, False, 0), ("e", "done", 9999, 200, False, 0, False, 0), ("f", "run", 900, 200, True, 29, True, 0), ("g", "run", 0, 200, True, 30, False, 1)], "run string, state string, age int, since_boot int, pid_alive boolean, gate_closed_s int, backoff boolean, clamped_s int")
    got = {r.run: (r.verdict, r.reasons) for r in H.heartbeat_verdict(h).collect()}
    assert got == {"a": ("STALL", ["no_progress"]), "b": ("OK", []), "c": ("OK", []), "d": ("WARN", ["gate_frozen"]), "e": ("DONE", []), "f": ("WARN", ["backoff"]), "g": ("WARN", ["gate_closed", "clamped"])}
    assert H.heartbeat_verdict(h.where(F.lit(False))).count() == 0


def test_diff_at_every_change(spark, tmp_path):
    """a: x, x, y, y, x, z has three changes, b none, c one."""
    data = [("a", 1, "x\nk"), ("b", 2, "p"), ("a", 3, "x\nk"), ("a", 4, "y\nk"), ("c", 5, None), ("a", 6, "y\nk"), ("a", 7, "x\nk"), ("c", 8, "q"), ("a", 9, "x\nk\nz"), ("b", 10, "p")]
    spark.createDataFrame(data, "source string, doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    # lines: two of the head, one of the place, one a text line shown
    got = sorted((r.site_id, r.ver, r.lines) for r in P.txt_23_diff(spark, str(tmp_path)).collect())
    assert got == [("a", 2, 6), ("a", 3, 6), ("a", 4, 5), ("c", 2, 4)]
