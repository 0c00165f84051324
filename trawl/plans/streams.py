"""Streaming queries (SM) over the tables' files, and the pluggable parts (UD)."""

from pyspark.sql import functions as F

from trawl.functions import classify as C
from trawl.operators import snapshots as S
from trawl.plans.classes import LEADS
from trawl.plans.tables import REQUESTS, requests
from trawl.streaming import jobs as J
from trawl.streaming.shared import scratch


class _Streaming:
    """spark.read turned into a stream, so that a batch mapping of a table serves both."""

    def __init__(self, spark):
        self.read = self
        self._spark = spark

    def parquet(self, path):
        return J.source(self._spark, path)


def _requests(spark, d):
    return requests(_Streaming(spark), d).withColumn("ts", F.col("ts").cast("timestamp"))


def bad():
    return F.col("status").isNull() | (F.col("status") >= 400)



def sm_01_seen(spark, d):
    """Whole keys, each once as long as it comes again within a month; a key's state goes a month behind the latest time."""
    r = _requests(spark, d).select("ts", F.concat_ws("/", "domain", "event_type", F.coalesce(F.col("status").cast("string"), F.lit("none"))).alias("key"))
    return J.run(J.seen_once(r, ["key"], "ts", "31 days"), "seen").select("key")


def sm_02_tumbling(spark, d):
    out = J.run_updates(J.outcome_counts(_requests(spark, d), "ts", ["event_type"], bad(), "1 hour"), "tumbling", ["window", "event_type"], "n")
    return out.select(F.unix_timestamp("window.start").alias("start"), "event_type", "n", "bad")


def sm_03_sliding(spark, d):
    out = J.run_updates(J.outcome_counts(_requests(spark, d), "ts", [], bad(), "2 hours", "1 hour"), "sliding", ["window"], "n")
    return out.select(F.unix_timestamp("window.start").alias("start"), "n", "bad")


def sm_04_sessions(spark, d):
    """All sessions: a closed one is written once, when the watermark has passed its end; those still open when the stream is drained are read from its state."""
    out = J.run_sessions(J.sessions(_requests(spark, d), "ts", "domain", "6 hours"), "sessions")
    return out.select("domain", F.unix_timestamp("session_window.start").alias("start"), "n")


def sm_05_breaker(spark, d):
    cls = F.when(F.col("event_id") % 400 > 250, "transient").when(F.col("status") == 429, "limited").when(F.col("status").isNull(), "blocked").when(F.col("status") >= 500, "transient").when(F.col("status") >= 400, "fatal").otherwise("ok")
    r = _requests(spark, d).select((F.col("domain") % 40).alias("domain"), F.col("event_id").alias("ord"), F.col("t").cast("double").alias("t"), cls.alias("cls"))
    return J.run(J.breaker(r), "breaker")


def sm_06_stall_alarms(spark, d):
    r = _requests(spark, d).select(F.col("domain").alias("run"), F.col("t").cast("double").alias("t"), F.expr("event_id div 1000").alias("mark"))
    return J.run(J.stall_alarms(r, 86_400), "stalls", rocks=True)


def sm_07_implausible(spark, d):
    r = _requests(spark, d).select("event_id", F.when(F.col("event_id") % 13 == 0, F.col("t") - 10**8).when(F.col("event_id") % 17 == 0, F.col("t") + 10**8).otherwise(F.col("t")).alias("t"))
    good, odd = J.plausible(r, "t", now=1_800_000_000, earliest=1_700_000_000)
    a, b = J.run(good, "plausible"), J.run(odd, "implausible")
    return a.select("event_id", F.lit(True).alias("plausible")).unionAll(b.select("event_id", F.lit(False)))


def sm_08_idempotent_sink(spark, d):
    r = _requests(spark, d).select(F.concat_ws("/", "domain", "event_type").alias("key"))
    return J.run(r, "sink", write=J.append_new(["key"]))


def sm_09_monitor(spark, d):
    docs = J.source(spark, f"{d}/documents.parquet", 1)
    c = docs.select(F.col("source").alias("site_id"), F.col("doc_id").alias("ord"), F.sha2("text", 256).alias("sha"))
    # the stream's files come by time of change, which needn't be the captures' order
    out = S.versions(J.run(c, "monitor", write=J.captures_into)).where("is_new = 1")
    return out.groupBy("site_id").agg(F.count("*").alias("versions"), F.max("ver").alias("last_ver"))


def _say(prompts):
    """Stands for a caller's classifier: it refuses prompts that end in a digit, and says nothing of use on some."""
    import re

    if any(p[-1:].isdigit() for p in prompts):
        raise ValueError("refused")
    return ["I can't tell." if len(p) % 11 == 0 else 'Verdict: {"intl": %s, "category": "%s"}.' % (str(bool(re.search("the|und", p))).lower(), "long" if len(p) > 1500 else "short") for p in prompts]


def ud_02_classifier(spark, d):
    """Leads are classified in two calls: the second one asks only for what the first one left, or failed at."""
    from trawl.operators import verdicts as V
    from trawl.plans.classes import _leads

    keys, ddl, path = ["kind", "value"], "intl boolean, category string", scratch(spark, "verdicts")
    leads = _leads(spark, d).where("value <> ''").select("kind", "value", "evidence", "conf", "doc_id", "src")
    for part in (leads.where("src < 'src2'"), leads):
        V.classify_new(part, path, _say, F.concat("value", F.lit(": "), "evidence"), ddl, "v1", keys, [(-F.col("conf")).alias("c"), F.col("doc_id").alias("i")])
    return V.verdicts(spark, path, leads, keys, ddl, "v1").select("kind", "value", "ok", "verdict.intl", "verdict.category", "error", "tries")


def ud_03_pattern_table(spark, d):
    """Patterns as data: a small table of rules, joined by first match."""
    rules = spark.createDataFrame([(i, k, p) for i, (k, p) in enumerate(C.PLATFORMS)], "rank int, kind string, pattern string")
    from trawl.plans.classes import LINKS
    from trawl.plans.tables import read

    p = read(spark, d, "pages").select("page_id", F.element_at(F.array(*map(F.lit, LINKS)), (F.col("page_id") % len(LINKS) + 1).cast("int")).alias("link"))
    # the rules are a fixed table of a few rows
    hit = p.join(F.broadcast(rules), F.expr("link RLIKE pattern"), "left")
    return hit.groupBy("page_id").agg(F.min_by("kind", "rank").alias("kind"))


QUERIES = {k: v for k, v in list(globals().items()) if k[:3] in ("sm_", "ud_")}
_BAD = "(status IS NULL OR status >= 400)"
SQL = {
    "sm_01_seen": f"WITH {REQUESTS} SELECT DISTINCT domain || '/' || event_type || '/' || coalesce(status::VARCHAR, 'none') AS key FROM req",
    "sm_02_tumbling": f"WITH {REQUESTS} SELECT t // 3600 * 3600 AS start, event_type, count(*) AS n, sum({_BAD}::INT) AS bad FROM req GROUP BY 1, 2",
    "sm_03_sliding": f"WITH {REQUESTS}, x AS (SELECT t // 3600 * 3600 - 3600 * k AS start, {_BAD} AS bad FROM req, (VALUES (0), (1)) v(k)) SELECT start, count(*) AS n, sum(bad::INT) AS bad FROM x GROUP BY 1",
    "sm_04_sessions": f"WITH {REQUESTS}, g AS (SELECT domain, ts, t, event_id, CASE WHEN ts >= lag(ts) OVER (PARTITION BY domain ORDER BY ts, event_id) + INTERVAL 6 HOUR OR lag(ts) OVER (PARTITION BY domain ORDER BY ts, event_id) IS NULL THEN 1 ELSE 0 END AS f FROM req), s AS (SELECT *, sum(f) OVER (PARTITION BY domain ORDER BY ts, event_id) AS sid FROM g) SELECT domain, min(t) AS start, count(*) AS n FROM s GROUP BY domain, sid",
    "sm_06_stall_alarms": f"""WITH {REQUESTS}, r AS (SELECT domain AS run, t, event_id // 1000 AS mark FROM req), c AS (SELECT *, lag(mark) OVER (PARTITION BY run ORDER BY t, mark) AS prev FROM r), i AS (SELECT run, t, lead(t) OVER (PARTITION BY run ORDER BY t, mark) AS nxt FROM c WHERE prev IS NULL OR prev <> mark)
      SELECT run, t + 86400.0::DOUBLE AS t, 'stall_detected' AS event FROM i WHERE coalesce(nxt, (SELECT max(t) FROM req)) - t >= 86400 UNION ALL SELECT run, nxt::DOUBLE, 'stall_cleared' FROM i WHERE nxt - t >= 86400""",
    "sm_07_implausible": "SELECT event_id, event_id % 13 <> 0 AND event_id % 17 <> 0 AS plausible FROM events",
    "sm_08_idempotent_sink": f"WITH {REQUESTS} SELECT DISTINCT domain || '/' || event_type AS key FROM req",
    "sm_09_monitor": "WITH l AS (SELECT source AS site_id, doc_id, sha256(text) AS sha, lag(sha256(text)) OVER (PARTITION BY source ORDER BY doc_id) AS prev FROM documents) SELECT site_id, count(*) AS versions, count(*) AS last_ver FROM l WHERE prev IS NULL OR sha <> prev GROUP BY 1",
    "ud_02_classifier": f"""WITH {LEADS}, l AS (SELECT *, src < 'src2' AS early FROM leads WHERE value <> ''), k AS (SELECT kind, value, bool_or(early) AS early, arg_min(value || ': ' || evidence, (-conf, doc_id)) FILTER (early) AS first, arg_min(value || ': ' || evidence, (-conf, doc_id)) AS best FROM l GROUP BY 1, 2),
      s AS (SELECT *, CASE WHEN p IS NULL THEN NULL WHEN regexp_matches(p, '[0-9]$') THEN 'ValueError: refused' WHEN length(p) % 11 = 0 THEN 'no verdict in the answer' ELSE '' END AS e FROM (SELECT *, first AS p FROM k)), t AS (SELECT *, CASE WHEN regexp_matches(best, '[0-9]$') THEN 'ValueError: refused' WHEN length(best) % 11 = 0 THEN 'no verdict in the answer' ELSE '' END AS e2 FROM s),
      u AS (SELECT *, coalesce(e = '', false) AS at_first, CASE WHEN coalesce(e = '', false) THEN p ELSE best END AS used FROM t)
      SELECT kind, value, at_first OR e2 = '' AS ok, CASE WHEN at_first OR e2 = '' THEN regexp_matches(used, 'the|und') END AS intl, CASE WHEN at_first OR e2 = '' THEN CASE WHEN length(used) > 1500 THEN 'long' ELSE 'short' END END AS category, nullif(greatest(CASE WHEN NOT at_first THEN coalesce(e, '') ELSE '' END, CASE WHEN NOT at_first THEN e2 ELSE '' END), '') AS error, CASE WHEN e IS NULL OR at_first THEN 1 ELSE 2 END AS tries FROM u""",
    "ud_03_pattern_table": "SELECT DISTINCT page_id, (['tg_link', 'fb_group', 'fb_page', 'wa_link', 'dc_link', 'ig_page', NULL])[page_id % 7 + 1] AS kind FROM pages",
}
