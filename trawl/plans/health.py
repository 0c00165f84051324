"""Health queries: WN-14..17, WN-19/20, VD-03, and snapshots WN-03..05, JN-16, AG-17, VD-11, TXT-10, TXT-23."""

import difflib

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T_
from pyspark.sql.functions import pandas_udf as udf

from trawl.functions import text as T
from trawl.functions.identifiers import identifiers
from trawl.operators import health as H
from trawl.operators import ledger as L
from trawl.operators import order as O
from trawl.operators import snapshots as S
from trawl.plans.tables import read, requests


def wn_14_watermarks(spark, d):
    e = read(spark, d, "events").select("user_id", "event_id", (F.col("event_id") - F.when(F.col("event_id") % 6 == 0, 900).otherwise(0)).alias("leaves"), F.floor(F.col("value") * 10).cast("long").alias("records"), F.unix_timestamp("ts").alias("t"))
    return H.watermarks(e, "user_id", ["event_id"], "leaves", "records", "t")


def wn_15_stalls(spark, d):
    e = read(spark, d, "events").select("user_id", "event_id", F.unix_timestamp("ts").alias("t"), (F.col("event_type") == "purchase").cast("int").alias("bought"))
    e = O.scan(O.dealt(e, ["user_id"], [F.col("event_id")]), ["user_id"], sums={"mark": F.col("bought")}).drop("bought", O.PART, O.AT)
    return H.stalls(e, "user_id", ["event_id"], "mark", "t", 86_400).select("event_id", "mark", "age")


def wn_16_no_progress(spark, d):
    e = read(spark, d, "events").select("user_id", "event_id", (F.col("event_type") == "purchase").alias("progressed"))
    return H.no_progress(e, "user_id", ["event_id"], "progressed").select("user_id", "event_id", "streak")


def wn_17_flapping(spark, d):
    t = F.unix_timestamp("ts")
    e = read(spark, d, "events").where("event_type = 'error'").select("user_id", "event_id", t.alias("t"))
    e = O.scan(O.dealt(e, ["user_id"], [F.col("event_id")]), ["user_id"], lags={"before": F.col("t")}).drop(O.PART, O.AT).withColumn("life", F.col("t") - F.col("before"))
    return H.flapping(e, "user_id", ["event_id"], "life", rapid=100_000).select("event_id", "rapid_n", "flapping", "wait")


def _outcomes(spark, d):
    cls = F.when(F.col("status") == 429, "limited").when(F.col("status").isNull(), "blocked").when(F.col("status") >= 500, "transient").when(F.col("status") >= 400, "fatal").otherwise("ok")
    return requests(spark, d).select((F.col("domain") % 40).alias("domain"), F.col("event_id").alias("ord"), F.col("t").cast("double").alias("t"), F.when(F.col("event_id") % 400 > 250, "transient").otherwise(cls).alias("cls"))


def wn_19_breaker(spark, d):
    return H.breaker(_outcomes(spark, d))


def wn_20_limiter(spark, d):
    return H.limiter(_outcomes(spark, d))


def vd_03_heartbeat(spark, d):
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("run"), F.when(F.col("o_orderkey") % 11 == 0, "done").otherwise("run").alias("state"), (F.col("o_orderkey") % 1800).alias("age"), (F.col("o_orderkey") % 240).alias("since_boot"), (F.col("o_orderkey") % 13 != 0).alias("pid_alive"), (F.col("o_orderkey") % 400).alias("gate_closed_s"), (F.col("o_orderkey") % 5 == 0).alias("backoff"), (F.col("o_orderkey") % 3).alias("clamped_s"))
    return H.heartbeat_verdict(o).select("run", "verdict", F.array_join("reasons", ",").alias("reasons"))


def _captures(spark, d):
    return read(spark, d, "documents").select(F.col("source").alias("site_id"), F.col("doc_id").alias("ord"), F.when(F.col("doc_id") % 9 == 4, F.lit("same")).otherwise(F.sha2("text", 256)).alias("sha"))


_VERS = """c AS (SELECT source AS site_id, doc_id AS ord, CASE WHEN doc_id % 9 = 4 THEN 'same' ELSE sha256(text) END AS sha FROM documents), l AS (SELECT *, lag(sha) OVER w AS prev, row_number() OVER w AS rn FROM c WINDOW w AS (PARTITION BY site_id ORDER BY ord)),
  n AS (SELECT *, CASE WHEN rn = 1 OR sha IS DISTINCT FROM prev THEN 1 ELSE 0 END AS is_new FROM l), v AS (SELECT *, sum(is_new) OVER (PARTITION BY site_id ORDER BY ord) AS ver, is_new = 1 AND sum(is_new) OVER (PARTITION BY site_id, sha ORDER BY ord) > 1 AS flap FROM n)"""


def wn_03_versions(spark, d):
    return S.versions(_captures(spark, d)).where("is_new = 1").select("site_id", "ord", "ver", "sha")


def wn_04_changes(spark, d):
    v = S.versions(_captures(spark, d)).where("is_new = 1 AND ver > 1")
    return v.select(F.concat("site_id", F.lit("#v"), "ver").alias("key"), F.substring("prev_sha", 1, 12).alias("old_sha12"), F.substring("sha", 1, 12).alias("new_sha12"), "ord")


def wn_05_flaps(spark, d):
    return S.versions(_captures(spark, d)).where("flap").select("site_id", "ord", "ver")


def jn_16_capture_state(spark, d):
    """New captures against the last known version of each site: baseline, unchanged, changed or failed."""
    c = _captures(spark, d)
    old = L.last_wins(c.where("ord % 2 = 0 AND site_id <> 'src7'"), ["site_id"], ["ord"]).select("site_id", F.col("sha").alias("old_sha"))
    new = L.last_wins(c.where("ord % 2 = 1 AND site_id <> 'src9'"), ["site_id"], ["ord"]).select("site_id", F.when(F.col("site_id") == "src3", None).otherwise(F.col("sha")).alias("new_sha"), F.lit(1).alias("tried"))
    x = old.join(new, "site_id", "full")
    state = F.when(F.col("tried").isNull(), "missing").when(F.col("new_sha").isNull(), "failed").when(F.col("old_sha").isNull(), "baseline").when(F.col("old_sha") == F.col("new_sha"), "unchanged").otherwise("changed")
    return x.select("site_id", state.alias("state"))


def ag_17_site_totals(spark, d):
    sites = read(spark, d, "documents").select(F.col("source").alias("site_id")).union(read(spark, d, "customer").select(F.concat(F.lit("src"), "c_nationkey"))).distinct()
    v = S.report(S.versions(_captures(spark, d)))
    x = sites.join(v, "site_id", "left")
    return x.agg(F.sum(F.col("captures").isNull().cast("int")).alias("missing"), F.count("captures").alias("ok"), F.sum("versions").alias("versions"))


def vd_11_monitor(spark, d):
    """Per site: state, versions, flaps, and watch words of the latest text. Texts are joined back for the latest captures only."""
    v = S.report(S.versions(_captures(spark, d)))
    last = read(spark, d, "documents").groupBy(F.col("source").alias("site_id")).agg(F.max("doc_id").alias("doc_id"))
    # one row a site, joined to the texts by id
    text = last.join(read(spark, d, "documents").select("doc_id", "text"), "doc_id")
    words = text.select("site_id", F.coalesce(F.aggregate(T.watch_counts(F.col("text"), ("the", "und", "que")), F.lit(0).cast("long"), lambda a, x: a + x.n), F.lit(0)).alias("watch_hits"))
    return v.join(words, "site_id").select("site_id", "versions", "changes", "flaps", "watch_hits")


# what the documents lack: a group's number, a number of members, links, an account, escaped signs
_SNIPPETS = ("群号：{}", "群 {} 人聚集", '<a href="https://t.me/joinchat/u{}">', "微信号：wx{}", "&#32676;&#21495;: {}", "<b>https://qm.qq.com/cgi-bin/qm/qr?k=K{}</b>", "QQ群：{} 群:{}")


def txt_10_identifiers(spark, d):
    """Identifiers of every document, read as a page with a line of contacts before its text."""
    docs = read(spark, d, "documents")
    number = (F.length("text") * 31 + F.col("doc_id") + 10_000).cast("string")
    snippet = F.element_at(F.array(*map(F.lit, _SNIPPETS)), (F.length("text") % len(_SNIPPETS) + 1).cast("int"))
    page = F.concat(F.replace(snippet, F.lit("{}"), number), F.lit(" | "), "text")
    return docs.select("doc_id", F.explode(identifiers(page)).alias("x")).select("doc_id", "x.kind", "x.value")


@udf(T_.StringType())
def diff_preview(old: pd.Series, new: pd.Series) -> pd.Series:
    """Unified diff with one line of context, 60 lines of 240 characters."""

    def one(a, b):
        lines = list(difflib.unified_diff((a or "").splitlines(), (b or "").splitlines(), "old", "new", lineterm="", n=1))
        return "\n".join([x[:240] for x in lines[:60]] + (["..."] if len(lines) > 60 else []))

    return pd.Series([one(a, b) for a, b in zip(old, new, strict=True)])


def txt_23_diff(spark, d):
    """Previews at every change: each version of a site against the version before it. Ids are paired first, then both texts are joined by id."""
    docs = read(spark, d, "documents").select(F.col("source").alias("site_id"), F.col("doc_id").alias("ord"), "text")
    v = S.versions(docs.select("site_id", "ord", F.sha2("text", 256).alias("sha"))).where("is_new = 1")
    # each version is the new one of its change and the old one of the next
    sides = v.select("site_id", "ord", F.explode(F.array(F.struct("ver", F.lit(True).alias("is_new")), F.struct((F.col("ver") + 1).alias("ver"), F.lit(False).alias("is_new")))).alias("x"))
    pair = sides.groupBy("site_id", "x.ver").agg(F.max(F.when(~F.col("x.is_new"), F.col("ord"))).alias("old_ord"), F.max(F.when(F.col("x.is_new"), F.col("ord"))).alias("new_ord")).where("old_ord IS NOT NULL AND new_ord IS NOT NULL")
    text = docs.select("ord", T.header_stripped(F.col("text")).alias("text"))  # a capture's head of # lines isn't content
    pair = pair.join(text.toDF("old_ord", "old"), "old_ord").join(text.toDF("new_ord", "new"), "new_ord")
    return pair.select("site_id", "ver", diff_preview("old", "new").alias("diff")).select("site_id", "ver", F.size(F.split("diff", "\n")).alias("lines"), F.length("diff").alias("chars"))


QUERIES = {k: v for k, v in list(globals().items()) if k[:3] in ("wn_", "vd_", "jn_", "ag_") or k[:4] == "txt_"}
SQL = {
    "wn_14_watermarks": """WITH e AS (SELECT user_id, event_id, event_id - CASE WHEN event_id % 6 = 0 THEN 900 ELSE 0 END AS leaves, floor(value * 10)::BIGINT AS records, floor(epoch(ts))::BIGINT AS t FROM events),
      p AS (SELECT *, coalesce(max(leaves) OVER q, 0) AS pl, coalesce(max(records) OVER q, 0) AS pr, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM e WINDOW q AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
      w AS (SELECT *, greatest(pl, leaves) AS wm_leaves, greatest(pr, records) AS wm_records, greatest(pl, leaves) > pl OR greatest(pr, records) > pr AS advanced, leaves < pl OR records < pr AS clamped FROM p),
      c AS (SELECT *, sum(advanced::INT) OVER u AS advance_count, sum(clamped::INT) OVER u AS clamp_events, sum((NOT clamped)::INT) OVER u AS isl, max(CASE WHEN advanced OR rn = 1 THEN t END) OVER u AS wm_t FROM w WINDOW u AS (PARTITION BY user_id ORDER BY event_id))
      SELECT user_id, event_id, leaves, records, t, wm_leaves, wm_records, advanced, clamped, advance_count, clamp_events, sum(clamped::INT) OVER i AS clamp_episode, CASE WHEN clamped THEN arg_min(t, event_id) FILTER (clamped) OVER i END AS first_clamp_t, wm_t FROM c WINDOW i AS (PARTITION BY user_id, isl ORDER BY event_id)""",
    "wn_15_stalls": "WITH e AS (SELECT user_id, event_id, floor(epoch(ts))::BIGINT AS t, sum((event_type = 'purchase')::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS mark FROM events), a AS (SELECT *, t - first_value(t) OVER (PARTITION BY user_id, mark ORDER BY event_id) AS age FROM e) SELECT event_id, mark, age FROM a WHERE age >= 86400 QUALIFY row_number() OVER (PARTITION BY user_id, mark ORDER BY event_id) = 1",
    "wn_16_no_progress": "WITH e AS (SELECT user_id, event_id, event_type = 'purchase' AS p, sum((event_type = 'purchase')::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS isl FROM events), s AS (SELECT *, sum((NOT p)::INT) OVER (PARTITION BY user_id, isl ORDER BY event_id) AS streak FROM e) SELECT user_id, event_id, streak FROM s WHERE streak = 5 AND NOT p",
    "wn_17_flapping": "WITH e AS (SELECT user_id, event_id, floor(epoch(ts))::BIGINT AS t FROM events WHERE event_type = 'error'), l AS (SELECT *, coalesce(t - lag(t) OVER (PARTITION BY user_id ORDER BY event_id) < 100000, false) AS short FROM e), i AS (SELECT *, sum((NOT short)::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS isl FROM l), n AS (SELECT *, sum(short::INT) OVER (PARTITION BY user_id, isl ORDER BY event_id) AS rapid_n FROM i) SELECT event_id, rapid_n, rapid_n >= 3 AS flapping, least(120, 5 * pow(2, greatest(rapid_n - 1, 0)))::INT AS wait FROM n",
    "vd_03_heartbeat": """WITH o AS (SELECT o_orderkey AS run, o_orderkey % 11 = 0 AS dn, o_orderkey % 1800 >= 900 AND o_orderkey % 240 >= 120 AND o_orderkey % 400 < 300 AS old, o_orderkey % 13 <> 0 AS alive, o_orderkey % 400 AS gate, o_orderkey % 5 = 0 AS bo, o_orderkey % 3 AS cl FROM orders)
      SELECT run, CASE WHEN dn THEN 'DONE' WHEN NOT alive OR (old AND NOT bo) THEN 'STALL' WHEN old OR gate >= 30 OR cl > 0 THEN 'WARN' ELSE 'OK' END AS verdict,
      CASE WHEN dn THEN '' ELSE array_to_string(list_filter([CASE WHEN NOT alive THEN 'process_dead' END, CASE WHEN old AND NOT bo THEN 'no_progress' END, CASE WHEN old AND bo THEN 'backoff' END, CASE WHEN gate >= 300 THEN 'gate_frozen' END, CASE WHEN gate BETWEEN 30 AND 299 THEN 'gate_closed' END, CASE WHEN cl > 0 THEN 'clamped' END], lambda x: x IS NOT NULL), ',') END AS reasons FROM o""",
    "wn_03_versions": f"WITH {_VERS} SELECT site_id, ord, ver, sha FROM v WHERE is_new = 1",
    "wn_04_changes": f"WITH {_VERS} SELECT site_id || '#v' || ver AS key, substr(prev, 1, 12) AS old_sha12, substr(sha, 1, 12) AS new_sha12, ord FROM v WHERE is_new = 1 AND ver > 1",
    "wn_05_flaps": f"WITH {_VERS} SELECT site_id, ord, ver FROM v WHERE flap",
    "jn_16_capture_state": f"WITH {_VERS}, o AS (SELECT site_id, arg_max(sha, ord) AS os FROM c WHERE ord % 2 = 0 AND site_id <> 'src7' GROUP BY 1), nw AS (SELECT site_id, CASE WHEN site_id <> 'src3' THEN arg_max(sha, ord) END AS ns, 1 AS tried FROM c WHERE ord % 2 = 1 AND site_id <> 'src9' GROUP BY 1) SELECT site_id, CASE WHEN tried IS NULL THEN 'missing' WHEN ns IS NULL THEN 'failed' WHEN os IS NULL THEN 'baseline' WHEN os = ns THEN 'unchanged' ELSE 'changed' END AS state FROM o FULL JOIN nw USING (site_id)",
    "ag_17_site_totals": f"WITH {_VERS}, g AS (SELECT site_id, sum(is_new) AS versions FROM v GROUP BY 1), s AS (SELECT source AS site_id FROM documents UNION SELECT 'src' || c_nationkey FROM customer) SELECT count(*) FILTER (versions IS NULL) AS missing, count(versions) AS ok, sum(versions) AS versions FROM s LEFT JOIN g USING (site_id)",
    "txt_10_identifiers": f"""WITH p AS (SELECT doc_id, replace(([{', '.join(f"'{x}'" for x in _SNIPPETS)}])[length(text) % {len(_SNIPPETS)} + 1], '{{}}', (length(text) * 31 + doc_id + 10000)::VARCHAR) || ' | ' || text AS raw FROM documents),
      q AS (SELECT doc_id, raw, replace(replace(regexp_replace(raw, '<[^>]+>', ' ', 'g'), '&#32676;', '群'), '&#21495;', '号') AS plain FROM p),
      x AS (SELECT doc_id, 'qq_num' AS kind, unnest(regexp_extract_all(regexp_replace(plain, '[0-9]+ 人聚集', '', 'g'), '群\\s*号?\\s*[:：]?\\s*([0-9]{{5,10}})\\b', 1)) AS value FROM q
        UNION ALL SELECT doc_id, 'tg', unnest(regexp_extract_all(raw, 't\\.me/(?:joinchat/)?([A-Za-z0-9_+%-]{{4,60}})', 1)) FROM q
        UNION ALL SELECT doc_id, 'wx_hint', unnest(regexp_extract_all(plain, '微信号?\\s*[:：]\\s*([A-Za-z][A-Za-z0-9_-]{{4,29}})', 1)) FROM q
        UNION ALL SELECT doc_id, 'qq_link', unnest(regexp_extract_all(raw, 'qm\\.qq\\.com/cgi-bin/qm/qr\\?[^\"\\s<>]*?k=[A-Za-z0-9_-]+', 0)) FROM q) SELECT DISTINCT doc_id, kind, value FROM x""",
    "vd_11_monitor": f"WITH {_VERS}, g AS (SELECT site_id, sum(is_new) AS versions, sum(is_new) - 1 AS changes, sum(flap::INT) AS flaps FROM v GROUP BY 1), t AS (SELECT source AS site_id, lower(arg_max(text, doc_id)) AS t FROM documents GROUP BY 1) SELECT site_id, versions, changes, flaps, (length(t) - length(replace(t, 'the', ''))) // 3 + (length(t) - length(replace(t, 'und', ''))) // 3 + (length(t) - length(replace(t, 'que', ''))) // 3 AS watch_hits FROM g JOIN t USING (site_id)",
}
