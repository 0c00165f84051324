"""Ledger queries: WN-01/02/18, AG-01/03/04/18, ST, SR, JN-01..04/15/17/18, VD-09/10."""

from pyspark.sql import functions as F

from trawl.operators import ledger as L
from trawl.operators.order import ranked
from trawl.plans.classes import LEADS, _leads
from trawl.plans.tables import read


def _records(spark, d):
    e = read(spark, d, "events")
    return e.select(F.concat_ws(":", "user_id", "event_type").alias("key"), F.col("event_id").alias("ord"), F.date_format("ts", "yyyy-MM-dd").alias("src"), "value")


_REC = "rec AS (SELECT user_id || ':' || event_type AS key, event_id AS ord, strftime(ts, '%Y-%m-%d') AS src, value FROM events)"


def wn_01_first_wins(spark, d):
    return L.first_wins(_records(spark, d), ["key"], ["ord"])


def wn_02_last_wins(spark, d):
    return L.last_wins(_records(spark, d), ["key"], ["ord"])


def ag_01_sources(spark, d):
    return L.sources_of(_records(spark, d), ["key"], "src", "ord").select("key", F.array_join("sources", ";").alias("sources"))


def ag_03_merge_views(spark, d):
    """Orders seen as catalogue records: holdings (supplier, part, flag) distinct, in order of first appearance."""
    li = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.concat_ws("/", "l_suppkey", F.col("l_partkey") % 7, "l_returnflag").alias("holding"))
    h = L.sources_of(li, ["l_orderkey"], "holding", "l_linenumber")
    first = L.first_wins(read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"), ["l_orderkey"], ["l_linenumber", "l_shipdate"])
    return first.join(h, "l_orderkey").select("l_orderkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("first_ship"), F.array_join("sources", ";").alias("holdings"))


def ag_04_counts(spark, d):
    return read(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "event_type").limit(12)


def ag_18_summary(spark, d):
    r = _records(spark, d)
    return r.agg(F.count("*").alias("records"), F.count_distinct("key").alias("keys"), F.count_distinct("src").alias("days"))


def st_01_union(spark, d):
    x = read(spark, d, "documents").select(F.md5("text").alias("value"), F.col("source").alias("src"), F.col("doc_id").alias("ord"))
    a, b = x.where("ord % 2 = 0"), x.where("ord % 3 = 0")
    return L.union_first(["value", "src"], a, b)


def st_02_views(spark, d):
    """Several sort-order views of one result set: union by id, and what is short of the total."""
    li = read(spark, d, "lineitem")
    views = li.where("l_linenumber <= 2").select("l_orderkey", "l_linenumber").unionByName(li.where("l_linenumber >= 2 AND l_linenumber <= 3").select("l_orderkey", "l_linenumber"))
    got = views.groupBy("l_orderkey").agg(F.count_distinct("l_linenumber").alias("got"))
    total = li.groupBy("l_orderkey").agg(F.count("*").alias("total"))
    return total.join(got, "l_orderkey", "left").select("l_orderkey", "total", F.coalesce("got", F.lit(0)).alias("got"), (F.coalesce("got", F.lit(0)) >= F.col("total") - 2).alias("complete"))


def st_03_differences(spark, d):
    li = read(spark, d, "lineitem")
    ref, cur = li.where("l_returnflag <> 'N'").select("l_partkey").distinct(), li.where("l_linenumber <= 3").select("l_partkey").distinct()
    return ref.subtract(cur).select(F.lit("lost").alias("what"), "l_partkey").unionAll(cur.subtract(ref).select(F.lit("extra"), "l_partkey"))


def st_04_repeats(spark, d):
    return read(spark, d, "documents").groupBy(F.md5("text").alias("key")).agg(F.count("*").alias("n")).where("n > 1")


def jn_01_verdicts(spark, d):
    return read(spark, d, "documents").select("doc_id", "source").join(L.last_wins(read(spark, d, "labels").select("doc_id", "quality", "toxic"), ["doc_id"], ["quality", "toxic"]), "doc_id", "left")


def jn_02_source_text(spark, d):
    p = read(spark, d, "pages")
    titles = L.first_wins(p.select("url", "page_id", F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1).alias("title")), ["url"], ["page_id"])
    x = p.select("page_id", F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(F.concat("url", F.lit("/x"))).alias("url")).join(titles.select("url", "title"), "url", "left")
    return x.select("page_id", F.when(F.col("title").isNotNull(), F.concat(F.substring("title", 1, 60), F.lit("（"), F.substring("url", 1, 60), F.lit("）"))).otherwise(F.substring("url", 1, 90)).alias("src"))


def _frontier(spark, d):
    e = read(spark, d, "events")
    c = e.select(F.concat_ws("/", F.col("user_id") % 97, "event_type", F.col("event_id") % 11).alias("url"), F.col("event_id").alias("ord"))
    seen, pending = c.where("ord % 7 = 0").select("url").distinct(), c.where("ord % 11 = 3").select("url").distinct()
    return c, seen, pending


_FRONT = "c AS (SELECT (user_id % 97) || '/' || event_type || '/' || (event_id % 11) AS url, event_id AS ord FROM events), fr AS (SELECT url, min(ord) AS ord FROM c WHERE url NOT IN (SELECT url FROM c WHERE ord % 7 = 0) AND url NOT IN (SELECT url FROM c WHERE ord % 11 = 3) GROUP BY url)"


def jn_03_frontier(spark, d):
    c, seen, pending = _frontier(spark, d)
    return L.frontier(c, "url", "ord", seen, pending)


def jn_04_unclassified(spark, d):
    x = _leads(spark, d).where("kind = 'qq_num'").select("doc_id", "value")
    return x.join(read(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")


def jn_15_missing(spark, d):
    """Expected tasks without a mark, per nation; converged: none."""
    c = read(spark, d, "customer")
    done = read(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("done", F.lit(1))
    x = c.join(done, "c_custkey", "left").groupBy("c_nationkey").agg(F.count("*").alias("expected"), F.sum(F.when(F.col("done").isNull(), 1).otherwise(0)).alias("missing"))
    return x.select("*", (F.col("missing") == 0).alias("converged"))


def jn_17_store_check(spark, d):
    a = read(spark, d, "documents").groupBy("source").agg(F.count("*").alias("store"))
    b = read(spark, d, "documents").where("doc_id % 10 <> 0").groupBy("source").agg(F.count("*").alias("file"))
    return a.join(b, "source", "full").select("source", F.coalesce("store", F.lit(0)).alias("store"), F.coalesce("file", F.lit(0)).alias("file"), (F.coalesce("store", F.lit(0)) - F.coalesce("file", F.lit(0))).alias("diff"))


def jn_18_redirects(spark, d):
    """Chains of at most four hops: even keys lead to their half; a chain that is still wrapped keeps where it began."""
    edges = read(spark, d, "part").where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("a"), F.expr("p_partkey div 2").alias("b"))
    x = read(spark, d, "part").select("p_partkey", F.col("p_partkey").alias("at"), F.lit(0).alias("hops"))
    for _ in range(4):
        x = x.join(edges, x["at"] == edges.a, "left").select("p_partkey", F.coalesce("b", "at").alias("at"), (F.col("hops") + F.col("b").isNotNull().cast("int")).alias("hops"))
    return x.select("p_partkey", F.when(F.col("at") % 2 == 0, F.col("p_partkey")).otherwise(F.col("at")).alias("target"), "hops")


def sr_01_merge_order(spark, d):
    """The merge order as a rank within each kind: conf falling, null as 0, then id."""
    x = _leads(spark, d).select("doc_id", "kind", F.when(F.col("doc_id") % 13 == 0, None).otherwise(F.col("conf")).alias("conf"))
    return ranked(x, ["kind"], [F.coalesce("conf", F.lit(0.0)).desc(), F.col("doc_id")]).select("doc_id", "kind", "rn")


def sr_02_top(spark, d):
    return _leads(spark, d).select("doc_id", "conf").orderBy(F.desc("conf"), "doc_id").limit(40)


def sr_03_top_per_section(spark, d):
    x = _leads(spark, d).join(read(spark, d, "labels"), "doc_id", "left").withColumn("section", F.when(F.col("toxic") == 1, "core").when(F.col("quality") == 1, "related").otherwise("other"))
    x = ranked(x.select("doc_id", "section", "conf"), ["section"], [F.desc("conf"), F.col("doc_id")])
    return x.where("section <> 'other' OR rn <= 80").select("doc_id", "section", "rn")


def sr_04_newest(spark, d):
    return read(spark, d, "events").select("event_id", "ts").orderBy(F.desc("ts"), F.desc("event_id")).limit(20).select("event_id")


def sr_05_batch(spark, d):
    return jn_03_frontier(spark, d).orderBy("ord").limit(500)


def sr_06_link_budget(spark, d):
    li = read(spark, d, "lineitem").select(F.col("l_suppkey").alias("page"), "l_orderkey", "l_linenumber")
    return L.top_per(li, ["page"], [F.col("l_orderkey"), F.col("l_linenumber")], 40)


def sr_07_dig_order(spark, d):
    """Score falling; articles without a score only within 70 % of the budget."""
    x = read(spark, d, "documents").select("source", "doc_id", (F.col("text").rlike("ingth|und der|que la").cast("int") * 2).alias("score"))
    budget = 20
    # the bound for all comes first: so many rows of a source are kept before they are sent
    x = L.top_per(x, ["source"], [F.desc("score"), F.col("doc_id")], budget)
    return x.where((F.col("score") > 0) | (F.col("rn") <= int(budget * 0.7)))


def sr_08_samples(spark, d):
    return L.top_per(read(spark, d, "events").select("event_type", "event_id"), ["event_type"], [F.col("event_id")], 4)


def wn_18_bounded(spark, d):
    return L.top_per(read(spark, d, "events").select("event_type", "event_id"), ["event_type"], [F.desc("event_id")], 500)


def vd_09_consistency(spark, d):
    x = _leads(spark, d)
    missing = x.where("value IS NULL OR value = ''").select(F.lit("missing_field").alias("issue"), "doc_id")
    repeats = x.groupBy("kind", "value").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1").groupBy(F.lit("duplicate").alias("issue")).agg(F.sum("n").alias("n"), F.min("first_doc").alias("first_doc"))
    evidence = x.where("NOT contains(evidence, value) AND kind NOT IN ('qq_link', 'fb_page')").select(F.lit("evidence").alias("issue"), "doc_id")
    return missing.unionAll(evidence).groupBy("issue").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).unionByName(repeats)


def vd_10_deliverable(spark, d):
    """Sections with verdict and source, best leads first, capped per section."""
    x = sr_03_top_per_section(spark, d).join(_leads(spark, d).select("doc_id", "kind", "value", "src", "conf"), "doc_id")
    return x.select("section", "rn", "kind", "value", F.substring("src", 1, 90).alias("src"), "conf")


QUERIES = {k: v for k, v in list(globals().items()) if k[:3] in ("wn_", "ag_", "st_", "jn_", "sr_", "vd_")}
_SECT = "s AS (SELECT l.*, CASE WHEN toxic = 1 THEN 'core' WHEN quality = 1 THEN 'related' ELSE 'other' END AS section FROM leads l LEFT JOIN labels USING (doc_id)), r AS (SELECT *, row_number() OVER (PARTITION BY section ORDER BY conf DESC, doc_id) AS rn FROM s)"
SQL = {
    "wn_01_first_wins": f"WITH {_REC} SELECT * FROM rec QUALIFY row_number() OVER (PARTITION BY key ORDER BY ord) = 1",
    "wn_02_last_wins": f"WITH {_REC} SELECT * FROM rec QUALIFY row_number() OVER (PARTITION BY key ORDER BY ord DESC) = 1",
    "ag_01_sources": f"WITH {_REC}, p AS (SELECT key, src, min(ord) AS o FROM rec GROUP BY 1, 2) SELECT key, string_agg(src, ';' ORDER BY o) AS sources FROM p GROUP BY 1",
    "ag_03_merge_views": "WITH l AS (SELECT l_orderkey, l_linenumber, l_shipdate, l_suppkey || '/' || (l_partkey % 7) || '/' || l_returnflag AS h FROM lineitem), p AS (SELECT l_orderkey, h, min(l_linenumber) AS o FROM l GROUP BY 1, 2), g AS (SELECT l_orderkey, string_agg(h, ';' ORDER BY o, h) AS holdings FROM p GROUP BY 1), f AS (SELECT l_orderkey, strftime(arg_min(l_shipdate, (l_linenumber, l_shipdate)), '%Y-%m-%d') AS first_ship FROM l GROUP BY 1) SELECT l_orderkey, first_ship, holdings FROM f JOIN g USING (l_orderkey)",
    "ag_04_counts": "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 12",
    "ag_18_summary": f"WITH {_REC} SELECT count(*) AS records, count(DISTINCT key) AS keys, count(DISTINCT src) AS days FROM rec",
    "st_01_union": "WITH x AS (SELECT md5(text) AS value, source AS src, doc_id AS ord FROM documents), u AS (SELECT *, 0 AS k FROM x WHERE ord % 2 = 0 UNION ALL SELECT *, 1 FROM x WHERE ord % 3 = 0) SELECT value, src, ord FROM u QUALIFY row_number() OVER (PARTITION BY value, src ORDER BY k, ord) = 1",
    "st_02_views": "WITH t AS (SELECT l_orderkey, count(*) AS total, count(DISTINCT CASE WHEN l_linenumber <= 3 THEN l_linenumber END) AS got FROM lineitem GROUP BY 1) SELECT l_orderkey, total, got, got >= total - 2 AS complete FROM t",
    "st_03_differences": "WITH a AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag <> 'N'), b AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_linenumber <= 3) SELECT 'lost' AS what, l_partkey FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'extra', l_partkey FROM (SELECT * FROM b EXCEPT SELECT * FROM a)",
    "st_04_repeats": "SELECT md5(text) AS key, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1",
    "jn_01_verdicts": "WITH l AS (SELECT doc_id, quality, toxic FROM labels QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY quality DESC, toxic DESC) = 1) SELECT doc_id, source, quality, toxic FROM documents LEFT JOIN l USING (doc_id)",
    "jn_02_source_text": "WITH t AS (SELECT url, arg_min(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), page_id) AS title FROM pages GROUP BY 1), x AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url ELSE url || '/x' END AS url FROM pages) SELECT page_id, CASE WHEN title IS NOT NULL THEN substr(title, 1, 60) || '（' || substr(url, 1, 60) || '）' ELSE substr(url, 1, 90) END AS src FROM x LEFT JOIN t USING (url)",
    "jn_03_frontier": f"WITH {_FRONT} SELECT url, ord FROM fr",
    "jn_04_unclassified": f"WITH {LEADS} SELECT doc_id, value FROM leads WHERE kind = 'qq_num' AND doc_id NOT IN (SELECT doc_id FROM labels)",
    "jn_15_missing": "WITH x AS (SELECT c_nationkey, count(*) AS expected, sum(CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 0 ELSE 1 END) AS missing FROM customer GROUP BY 1) SELECT *, missing = 0 AS converged FROM x",
    "jn_17_store_check": "SELECT source, count(*) AS store, sum(CASE WHEN doc_id % 10 <> 0 THEN 1 ELSE 0 END) AS file, count(*) - sum(CASE WHEN doc_id % 10 <> 0 THEN 1 ELSE 0 END) AS diff FROM documents GROUP BY 1",
    "jn_18_redirects": """WITH RECURSIVE ch AS (SELECT p_partkey, p_partkey AS cur, 0 AS hops FROM part UNION ALL SELECT p_partkey, cur // 2, hops + 1 FROM ch WHERE cur % 2 = 0 AND hops < 4 AND cur IN (SELECT p_partkey FROM part))
      SELECT p_partkey, CASE WHEN cur % 2 = 0 THEN p_partkey ELSE cur END AS target, hops FROM ch QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY hops DESC) = 1""",
    "sr_01_merge_order": f"WITH {LEADS} SELECT doc_id, kind, row_number() OVER (PARTITION BY kind ORDER BY coalesce(CASE WHEN doc_id % 13 <> 0 THEN conf END, 0) DESC, doc_id) AS rn FROM leads",
    "sr_02_top": f"WITH {LEADS} SELECT doc_id, conf FROM leads ORDER BY conf DESC, doc_id LIMIT 40",
    "sr_03_top_per_section": f"WITH {LEADS}, {_SECT} SELECT doc_id, section, rn FROM r WHERE section <> 'other' OR rn <= 80",
    "sr_04_newest": "SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 20",
    "sr_05_batch": f"WITH {_FRONT} SELECT url, ord FROM fr ORDER BY ord LIMIT 500",
    "sr_06_link_budget": "SELECT l_suppkey AS page, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) AS rn FROM lineitem QUALIFY rn <= 40",
    "sr_07_dig_order": "WITH x AS (SELECT source, doc_id, CASE WHEN regexp_matches(text, 'ingth|und der|que la') THEN 2 ELSE 0 END AS score FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS rn FROM x) SELECT * FROM r WHERE rn <= CASE WHEN score > 0 THEN 20 ELSE 14 END",
    "sr_08_samples": "SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events QUALIFY rn <= 4",
    "wn_18_bounded": "SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS rn FROM events QUALIFY rn <= 500",
    "vd_09_consistency": f"WITH {LEADS}, i AS (SELECT 'missing_field' AS issue, doc_id FROM leads WHERE value IS NULL OR value = '' UNION ALL SELECT 'duplicate', doc_id FROM (SELECT doc_id, count(*) OVER (PARTITION BY kind, value) AS n FROM leads) WHERE n > 1 UNION ALL SELECT 'evidence', doc_id FROM leads WHERE NOT contains(evidence, value) AND kind NOT IN ('qq_link', 'fb_page')) SELECT issue, count(*) AS n, min(doc_id) AS first_doc FROM i GROUP BY 1",
    "vd_10_deliverable": f"WITH {LEADS}, {_SECT} SELECT section, rn, kind, value, substr(src, 1, 90) AS src, conf FROM r WHERE section <> 'other' OR rn <= 80",
}
