"""Queries against their SQL on tables that lie in several files, as large ones do."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from trawl import catalog
from trawl.functions import text as T
from trawl.functions.identifiers import SLICE, identifiers
from trawl.streaming import jobs

SF = "/root/testdata/sf0.01"


def same(spark, d, name, *tables):
    """The query's rows are those of its SQL."""
    con = duckdb.connect()
    for t in tables:
        at = f"{d}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at}{'/*.parquet' if os.path.isdir(at) else ''}'")
    df = catalog.queries()[name](spark, d)
    want = con.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    key = lambda row: tuple(map(str, row))
    assert sorted(map(key, df.select(*columns).collect())) == sorted(map(key, want.fetchall()))


@pytest.fixture
def late_broadcast(spark):
    """A join of lines with a row for each file is planned by sorting, as between large tables, and becomes a broadcast join of those few rows while the query runs."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "30k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.unset(k)


def several_files(spark, d):
    spark.read.parquet(f"{SF}/documents.parquet").repartition(6, "text").write.parquet(f"{d}/documents.parquet")


def test_ingest_of_files_that_one_task_writes(spark, tmp_path, late_broadcast):
    several_files(spark, tmp_path)
    same(spark, str(tmp_path), "src_01_ingest", "documents")


def test_attribution_of_files_that_one_task_writes(spark, tmp_path, late_broadcast):
    several_files(spark, tmp_path)
    same(spark, str(tmp_path), "src_04_attribution", "documents")


def test_monitor_of_files_that_come_in_another_order(spark, tmp_path):
    """The file with the later captures is the older one."""
    x, at = spark.read.parquet(f"{SF}/documents.parquet"), f"{tmp_path}/documents.parquet"
    for i, part in enumerate(("doc_id >= 500", "doc_id < 300", "doc_id BETWEEN 300 AND 499")):
        x.where(part).coalesce(1).write.mode("append").parquet(at)
        for f in os.listdir(at):
            if f.endswith(".parquet") and os.stat(f"{at}/{f}").st_mtime > 1e9 + 9:
                os.utime(f"{at}/{f}", (1e9 + i, 1e9 + i))
    same(spark, str(tmp_path), "sm_09_monitor", "documents")


def test_captures_of_a_batch_that_comes_again(spark, tmp_path):
    for _ in range(2):
        jobs.captures_into(spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "site_id string, ord long, sha string"), 0, f"file://{tmp_path}/c")
    assert spark.read.parquet(f"{tmp_path}/c").count() == 2


def test_references_that_markup_cuts_off(spark, tmp_path):
    pages = [(0, "u", "<title>a&amp;&amp;&amp</title>b"), (1, "u", "<b>&quo</b>&amp;lt;&amp<script>x</script>"), (2, "u", "x &copy; &amp"), (3, "u", "&middot;&am<br>")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    same(spark, str(tmp_path), "txt_02_html_plain", "pages")
    got = spark.createDataFrame([("a &copy b &amp;c&#233;&eacute d<i>&amp</i>",)], "h string").select(T.html_plain("h")).first()[0]
    assert got == "a © b &céé d &amp "


def test_plain_text_of_whole_pages(spark, tmp_path):
    """Pages of more than 200,000 characters, one with a script across that point."""
    long = "<p>some words &amp; more</p>\n" * 12_000
    pages = [(0, "u", long + "the end"), (1, "u", long[:199_990] + "<script>x" + "y" * 50 + "</script> tail &copy;"), (2, "u", "short")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    same(spark, str(tmp_path), "txt_02_html_plain", "pages")
    got = spark.createDataFrame([(long + "the end",)], "h string").select(T.html_plain("h")).first()[0]
    assert got.endswith("the end") and got.count("some words & more") == 12_000


def test_sessions_still_open_at_the_end(spark, tmp_path):
    """Every event is in a session, in whatever batches the events come."""
    same(spark, SF, "sm_04_sessions", "events")
    sizes = catalog.queries()["sm_04_sessions"](spark, SF).agg(F.sum("n")).first()[0]
    assert sizes == spark.read.parquet(f"{SF}/events.parquet").count()
    for i in range(4):
        spark.createDataFrame([(u, 1e6 + i * 10_000.0 + k) for u in range(20) for k in range(3)], "u long, t double").select("u", F.timestamp_seconds("t").alias("ts")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    s = spark.readStream.schema("u long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got = jobs.run_sessions(jobs.sessions(s, "ts", "u", "10 minutes", "1 minute"), "sessions")
    assert got.groupBy("n").count().collect() == [(3, 80)]


def test_files_of_the_tree_are_full(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("trawl.plans.sources.scratch", lambda spark, name: f"file://{tmp_path}/{name}")
    same(spark, SF, "src_06_tree", "documents")
    sizes = [len(f.read_text().splitlines()) for f in tmp_path.rglob("*.txt")]
    x = spark.read.parquet(f"{SF}/documents.parquet")
    assert max(sizes) <= 100 and sum(sizes) == x.count() and len(sizes) <= x.count() / 100 + x.select("source").distinct().count()


def test_titles_without_a_pass_over_the_whole_text(spark, tmp_path):
    texts = ["", "1" * 5000 + "ab", "é9 " * 40, "a" * 19 + "1" * 99 + "bc", "😀x\ny" * 30, "no 20"] * 20
    spark.createDataFrame([(i, t, "s", "en", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, source string, lang string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    same(spark, str(tmp_path), "src_03_salvage", "documents")
    plan = catalog.queries()["src_03_salvage"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract(text#" in plan and "regexp_replace(text#" not in plan


def test_identifiers_of_more_pages_than_a_slice(spark):
    """Pages reach Python as Arrow's own array, not as a batch of Python texts."""
    pages = [(i, None if i % 7 == 0 else f"群号：{10_000 + i}") for i in range(SLICE * 3 + 5)]
    df = spark.createDataFrame(pages, "i int, page string").coalesce(1).select("i", identifiers(F.col("page")).alias("x"))
    assert "], 250" in df._jdf.queryExecution().optimizedPlan().toString()
    assert {r.i: [h.value for h in r.x] for r in df.collect()} == {i: [] if p is None else [str(10_000 + i)] for i, p in pages}
