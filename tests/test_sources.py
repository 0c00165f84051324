import random

import pytest
from pyspark.sql import functions as F

from trawl.functions import classify as C
from trawl.functions import text as T
from trawl.operators import audit as A
from trawl.operators import coverage as V
from trawl.operators import ledger as L
from trawl.sources import jsonl as J
from trawl.sources import sinks as K


def test_ingest_files(spark, tmp_path):
    for name, text in {"a.jsonl": '{"k":1}\nNOT-JSON\n{"k":2}\n{"k":3,"half":', "b.jsonl": '{"k":4}\n', "c.jsonl": ""}.items():
        (tmp_path / name).write_text(text)
    lines = J.read_lines(spark, str(tmp_path))
    got = {r.file[-7:]: (r.lines, r.bad_lines, r.truncated_bytes, r.repaired) for r in J.repair_report(J.parsed(lines, "k int")).collect()}
    assert got == {"a.jsonl": (4, 1, 14, True), "b.jsonl": (1, 0, 0, False)}
    assert J.read_tree(spark, str(tmp_path), "*.jsonl").count() == 2  # Spark gives no row for an empty file


def small_ranges(spark, size):
    """Spark reads files in ranges of so many bytes."""
    for k, v in {"maxPartitionBytes": size, "openCostInBytes": 1, "minPartitionNum": 1}.items():
        spark.conf.set(f"spark.sql.files.{k}", v)


@pytest.fixture
def ranges(spark):
    yield lambda size: small_ranges(spark, size)
    for k in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{k}")


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
def test_lines_of_files_in_ranges(spark, tmp_path, ranges, size):
    r = random.Random(size)
    texts = {"torn": "a\nbb\n\n{x", "whole": "a\n\n", "none": "", "one": "x", "end": "\n", "cr": "a\r\nb\r"}
    texts["long"] = "\n".join("é" * r.randint(0, 40) for _ in range(300))
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    ranges(size)
    lines = J.read_lines(spark, str(tmp_path))
    assert size > 1000 or lines.select("file", "_part").distinct().count() > len(texts)
    got = {}
    for x in lines.collect():
        got.setdefault(x.file.split("/")[-1], []).append((x.line_no, x.value, x.last))
    for name, text in texts.items():
        want = text.removesuffix("\n").split("\n") if text else []
        assert sorted(got.get(name, [])) == [(i + 1, v, i + 1 == len(want) and not text.endswith("\n")) for i, v in enumerate(want)], name


def test_repair(spark, tmp_path, ranges):
    for name, text in {"tear": '{"k":1}\n{"k":2}\n{"k":3,"half":', "mid": '{"k":1}\nNOT-JSON\n{"k":3}\n', "good": '{"k":1}\n{"k":2}', "bad": "x\n"}.items():
        (tmp_path / name).write_text(text)
    ranges(9)
    p = J.parsed(J.read_lines(spark, str(tmp_path)), "k int").withColumn("file", F.substring_index("file", "/", -1))
    assert {r.file: (r.lines, r.bad_lines, r.truncated_bytes, r.repaired) for r in J.repair_report(p).collect()} == {"tear": (3, 0, 14, True), "mid": (3, 1, 0, True), "good": (2, 0, 0, False), "bad": (1, 1, 0, True)}
    good, quarantine = J.repaired(p)
    assert sorted((r.file, r.line_no) for r in good.collect()) == [("good", 1), ("good", 2), ("mid", 1), ("mid", 3), ("tear", 1), ("tear", 2)]
    assert sorted(map(tuple, quarantine.collect())) == [("bad", 1, "x"), ("mid", 2, "NOT-JSON")]


def test_attribution_across_ranges(spark, tmp_path, ranges):
    """A damaged line takes its prefix from a good line many ranges before."""
    (tmp_path / "f").write_text('{"mms":"1","prefix":"A"}\n' + "junk junk junk\n" * 200 + '{"mms":"2","prefix":"B"}\ntorn')
    ranges(50)
    got = J.attributed(J.read_lines(spark, str(tmp_path))).groupBy("prefix", "inferred").count().collect()
    assert sorted(map(tuple, got)) == [("A", True, 200), ("B", True, 1)]


def test_salvage_and_attribution(spark):
    rows = [("f", 1, '{"mms":"1","prefix":"A"}'), ("f", 2, '{"mms":"x","prefix":"Q","ti{"mms":"2","prefix":"B"}'), ("f", 3, "junk"), ("f", 4, '{"mms":"","prefix":"C"}'), ("f", 5, '{"mms":"3","prefix":null}'), ("g", 1, "torn {\"a\": 1}"), ("g", 2, None)]
    got = [(r.file, r.line_no, r.salvaged, r.prefix, r.inferred) for r in J.attributed(spark.createDataFrame(rows, "file string, line_no int, value string")).orderBy("file", "line_no").collect()]
    assert got == [("f", 2, '{"mms":"2","prefix":"B"}', "Q", False), ("f", 3, None, "A", True), ("f", 4, None, "C", False), ("g", 1, '{"a": 1}', None, False), ("g", 2, None, None, False)]


def test_decode(spark):
    data = [(0, "é".encode(), None), (1, "é".encode("latin-1"), "latin-1"), (2, "中文".encode("gbk"), None), (3, b"a\xff\xfe", None), (4, None, None), (5, "é".encode(), "no-such-charset")]
    df = spark.createDataFrame(data, "i int, data binary, charset string")
    assert [r.t for r in df.select("i", J.decode(F.col("data"), F.col("charset")).alias("t")).orderBy("i").collect()] == ["é", "é", "中文", "a", None, "é"]


def test_sinks(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    a = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k int, v string")
    K.append_new(a, path, ["k"])
    K.append_new(a.unionAll(spark.createDataFrame([(3, "c")], "k int, v string")), path, ["k"])
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_ledger(spark):
    df = spark.createDataFrame([("k", 2, "u2"), ("k", 1, "u1"), ("k", 3, "u2"), ("j", 4, None)], "key string, ord int, src string")
    assert {r.key: r.ord for r in L.first_wins(df, ["key"], ["ord"]).collect()} == {"k": 1, "j": 4}
    assert {r.key: r.ord for r in L.last_wins(df, ["key"], ["ord"]).collect()} == {"k": 3, "j": 4}
    assert {r.key: r.sources for r in L.sources_of(df, ["key"], "src", "ord").collect()} == {"k": ["u1", "u2"]}
    seen = spark.createDataFrame([("j",)], "key string")
    assert [r.key for r in L.frontier(df, "key", "ord", seen).collect()] == ["k"]


def test_sequence(spark):
    rows = [(1, i, s) for i, s in enumerate([1, 2, 2, 5, 3, 4])] + [(2, 0, 2), (2, 1, 3)]
    got = sorted((r.g, r.line, r.issue) for r in A.sequence_issues(spark.createDataFrame(rows, "g int, line int, seq int"), ["g"]).collect())
    assert got == [(1, 2, "seq_duplicate"), (1, 3, "seq_gap"), (1, 4, "seq_reorder"), (2, 0, "seq_group_not_from_1")]


def test_reconcile_order(spark):
    led = lambda rows: spark.createDataFrame(rows, "p string, total long, type string")
    todo, done, gaps = led([("t1", 100, None), ("t2", 100, None), ("t3", 100, None), ("t4", 0, None), ("t5", None, None)]), led([("d1", 100, None), ("d2", 100, None), ("d3", 100, None)]), led([("g1", 100, "leaf"), ("g2", 100, "branch")])
    counts = spark.createDataFrame([("t1", 98), ("t2", 97), ("t3", 100), ("d1", 98), ("d2", 10), ("d3", 100), ("g1", 98), ("g2", 100)], "p string, cnt long")
    got = {r.p: (r.decision, r.tolerance_mark) for r in V.reconcile(todo, done, gaps, counts, spark.createDataFrame([("t3",), ("d3",)], "p string"), ["p"]).collect()}
    assert got == {"t1": ("todo_to_done", True), "t2": ("keep", False), "t3": ("keep_forced", False), "t4": ("keep", False), "t5": ("keep", False), "d1": ("keep", True), "d2": ("done_to_todo", False), "d3": ("torn_to_todo", False), "g1": ("gap_resolved", True), "g2": ("keep", False)}


def test_convergence(spark):
    runs = spark.createDataFrame([(1, 1, 0, 0, 0), (2, 0, 0, 0, 0), (3, 0, 2, 2, 1), (4, 0, 2, 2, 0), (5, 0, 2, 1, 0)], "run int, todo int, open_gaps int, terminal_gaps int, fixed int")
    assert {r.run: (r.reason, r.terminal, r.exit_code) for r in V.convergence(runs).collect()} == {1: ("todo-pending", False, None), 2: ("no-todo-no-open-gaps", True, 0), 3: ("repair-progress", False, None), 4: ("repair-budget-exhausted", True, 3), 5: ("repair-budget-left", False, None)}


def test_classes(spark):
    df = spark.createDataFrame([(["ConnectTimeout", "Timeout"], "connect timed out"), (["ConnectionError"], "Failed to resolve name"), (["JSONDecodeError", "ValueError"], "read timeout"), (["ReadTimeout"], ""), (None, None)], "names array<string>, msg string")
    assert [r.c for r in df.select(C.failure_class(F.col("names"), F.col("msg")).alias("c")).collect()] == ["conn_reset", "dns", "data", "read_timeout", "other"]
    pages = spark.createDataFrame([(None,), ("",), ("x" * 8000 + "captcha",), ("Rate limit",), ("rate limit",), ("请稍后再试 captcha",), ("CAPTCHA",)], "b string")
    assert [r.c for r in pages.select(C.body_class(F.col("b")).alias("c")).collect()] == [None, None, None, None, "soft_limit", "blocked", "challenge"]


def test_text(spark):
    df = spark.createDataFrame([("<p>a&amp;b</p><script>x</script><br/>c  d",), (None,), ("<script>never closed",)], "h string")
    assert [r.t for r in df.select(T.html_text(F.col("h")).alias("t")).collect()] == ["a&b\n\nc d".replace("\n\n", "\n"), "", "never closed"]
    links = spark.createDataFrame([('<a href="/x"><a href="y"><a href="//h/z"><a href="mailto:a"><a href="http://q/"><a href="#f">', "https://h.org/a/b?c")], "h string, u string")
    assert links.select(T.links(F.col("h"), F.col("u")).alias("l")).first().l == ["https://h.org/x", "https://h.org/a/y", "https://h/z", "http://q/"]


def test_keyed_sink_reads_only_its_buckets(spark, tmp_path):
    """A batch goes through although every bucket but its own is unreadable; buckets with many files become one file."""
    import glob
    import os

    path, schema = f"file://{tmp_path}/t", "k int, v string"
    K.append_new(spark.createDataFrame([(i, "a") for i in range(500)], schema), path, ["k"])
    K.append_new(spark.createDataFrame([(None, "n"), (None, "n")], schema), path, ["k"])
    batch = spark.createDataFrame([(7, "again"), (9, "again"), (1000, "new"), (None, "n")], schema)
    mine = {r[0] for r in batch.select(K.bucket_of(["k"])).collect()}
    files = [f for f in glob.glob(f"{tmp_path}/t/_bucket=*/*.parquet") if int(f.split("_bucket=")[1].split("/")[0]) not in mine]
    kept = {f: open(f, "rb").read() for f in files}
    assert len(files) > 40
    for f in files:
        os.remove(os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc"))
        open(f, "wb").write(b"no parquet file")
    K.append_new(batch, path, ["k"])
    K.append_new(batch, path, ["k"])
    for f, data in kept.items():
        open(f, "wb").write(data)
    rows = lambda: sorted((r.k is None, r.k, r.v) for r in spark.read.schema(schema).parquet(path).collect())
    before = rows()
    assert len(before) == 502 and (False, 1000, "new") in before and (False, 7, "a") in before
    for i in range(3):
        K.append_new(spark.createDataFrame([(2000 + j, "m") for j in range(i * 300, i * 300 + 300)], schema), path, ["k"])
    before, done = rows(), K.compact(spark, path, batch.schema, 2)
    assert done and rows() == before and all(len(glob.glob(f"{tmp_path}/t/_bucket={b}/*.parquet")) == 1 for b in done)
