"""Metrics and windows: AG-05..14, AG-16, WN-08..13, SM-02/03 in batch form."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from trawl.functions import classify as C
from trawl.operators import ledger as L
from trawl.operators import metrics as M
from trawl.operators import sliding as S
from trawl.operators.selection import percentiles
from trawl.plans.tables import REQUESTS, read, requests

def bad():
    return F.col("status").isNull() | (F.col("status") >= 400)

_BAD = "(status IS NULL OR status >= 400)"


def ag_05_grouping_sets(spark, d):
    r = requests(spark, d).select(C.size_class(F.col("lim")).alias("level"), "event_type", C.retry_class(F.col("status")).alias("layout"))
    sets = r.groupingSets([["level"], ["event_type"], ["layout"]], "level", "event_type", "layout")
    return sets.agg(F.count("*").alias("n"))


def ag_06_offenders(spark, d):
    r = requests(spark, d)
    return r.where(F.col("status") == 403).groupBy("domain").agg(F.count("*").alias("n")).where("n > 5")


def ag_07_record_quality(spark, d):
    li = read(spark, d, "lineitem").select(F.when(F.col("l_linenumber") == 7, None).otherwise(F.concat_ws("-", "l_orderkey", F.col("l_linenumber") % 3)).alias("mms"), F.col("l_suppkey").alias("run"), (F.col("l_partkey") % 50 == 0).alias("bad"))
    good = ~F.col("bad")
    return li.groupBy("run").agg(F.count("*").alias("lines"), F.sum(good.cast("long")).alias("valid"), F.sum((good & F.col("mms").isNull()).cast("long")).alias("missing_id"), F.count_distinct(F.when(good, F.col("mms"))).alias("unique"), (F.count(F.when(good, F.col("mms"))) - F.count_distinct(F.when(good, F.col("mms")))).alias("duplicate"))


def ag_08_request_log(spark, d):
    r = requests(spark, d)
    return r.groupBy("domain").agg(F.count("*").alias("total"), F.sum((F.col("lim") <= 1).cast("long")).alias("probe"), F.sum((F.col("lim") >= 500).cast("long")).alias("full_page"), *[F.sum(F.coalesce(F.col("status") == s, F.lit(False)).cast("long")).alias(f"s{s}") for s in (200, 429, 503)])


def ag_09_duplicate_work(spark, d):
    r = requests(spark, d).where("lim >= 500")
    return r.groupBy("domain", "event_type").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "domain", "event_type").limit(8)


def ag_10_distribution(spark, d):
    return M.summary(read(spark, d, "events"), ["event_type"], "value")


def ag_11_end_to_end(spark, d):
    """Queue and transfer times added up, by kind and overall."""
    li = read(spark, d, "lineitem").select(F.col("l_returnflag").alias("kind"), F.col("l_quantity").cast("long").alias("http"), (F.col("l_partkey") % 60).alias("wait"))
    li = li.withColumn("e2e", F.col("http") + F.col("wait"))
    # the total is a group of its own that holds all rows
    li = li.select(F.explode(F.array(F.struct("kind", F.lit(0).alias("level")), F.struct(F.lit(None).cast("string").alias("kind"), F.lit(1).alias("level")))).alias("of"), "http", "wait", "e2e").select("of.kind", "of.level", "http", "wait", "e2e")
    out = li.groupBy("kind", "level").agg(F.count("*").alias("n"), F.sum((F.col("e2e") > 90).cast("long")).alias("over_n"))
    ranks = percentiles(li, ["kind", "level"], {f"{c}_p95": (c, 0.95) for c in ("http", "wait", "e2e")}).withColumnRenamed("kind", "of").withColumnRenamed("level", "at")
    out = out.join(ranks, out["kind"].eqNullSafe(ranks["of"]) & (out["level"] == ranks["at"]))
    return out.select("kind", "n", "http_p95", "wait_p95", "e2e_p95", "over_n", (F.col("e2e_p95") > 90).alias("p95_over"))


def ag_12_active_window(spark, d):
    """Each run's own samples against its bounds: sign-ups begin a run and purchases end it, where there are any."""
    r = requests(spark, d).select("domain", "t", "event_type")
    bounds = r.groupBy("domain").agg(F.min(F.when(F.col("event_type") == "signup", F.col("t"))).alias("start"), F.max(F.when(F.col("event_type") == "purchase", F.col("t"))).alias("end"))
    return M.active_window(r.where("event_type IN ('click', 'view')"), "domain", "t", bounds)


def ag_13_throughput(spark, d):
    """Unique keys a day on the run's own span, and the difference in per cent against the run with id 1."""
    r = requests(spark, d).groupBy("domain").agg(F.count_distinct("event_type", "status").alias("uniq"), F.count("*").alias("n"), (F.max("t") - F.min("t")).alias("span"))
    r = r.select("domain", "uniq", "n", F.when(F.col("span") > 0, F.floor(F.col("n") * 8640000 / F.col("span"))).alias("per_day_100"))
    base = r.where("domain = 1").agg(F.max("per_day_100").alias("base"))  # one row by its form
    return r.join(F.broadcast(base), F.lit(True)).select("domain", "uniq", "n", "per_day_100", F.when(F.col("base") > 0, F.floor((F.col("per_day_100") - F.col("base")) * 1000 / F.col("base"))).alias("delta_permille"))


def ag_14_rate_bands(spark, d):
    r = requests(spark, d).groupBy((F.col("t") / 3600).cast("long").alias("hour")).agg(F.count("*").alias("rate"), F.sum(F.coalesce(F.col("status") == 429, F.lit(False)).cast("long")).alias("errors"))
    b = r.groupBy("rate").agg(F.sum("errors").alias("errors"), F.count("*").alias("hours"))
    return b.agg(F.max(F.when(F.col("errors") == 0, F.col("rate"))).alias("highest_clean"), F.min(F.when(F.col("errors") > 0, F.col("rate"))).alias("first_errors"), F.sum("hours").alias("hours"))


def ag_16_limiter_snapshot(spark, d):
    r = L.top_per(requests(spark, d).select("domain", "event_id", "t", "status"), ["domain"], [F.desc("t"), F.desc("event_id")], 20)
    gap = F.col("t") - F.lag("t").over(Window.partitionBy("domain").orderBy("t", "event_id"))
    r = r.withColumn("gap", gap)
    return r.groupBy("domain").agg(F.count("*").alias("n"), F.sum(bad().cast("long")).alias("errors"), F.min("gap").alias("gap_min"), F.max("gap").alias("gap_max"), M.nearest_rank("gap", 0.5).alias("gap_p50"), M.nearest_rank("gap", 0.8).alias("gap_p80"))


def ag_19_issue_rollup(spark, d):
    r = requests(spark, d).withColumn("issue", C.retry_class(F.col("status"))).where("issue <> 'other'").select("issue", "event_id")
    n = r.groupBy("issue").agg(F.count("*").alias("n"))
    ex = L.top_per(r, ["issue"], [F.col("event_id")], 4).groupBy("issue").agg(F.array_join(F.transform(F.sort_array(F.collect_list("event_id")), lambda x: x.cast("string")), ",").alias("examples"))
    return n.join(ex, "issue").select("issue", "n", "examples", F.col("issue").isin("auth", "fatal").alias("hard")).orderBy(F.desc("n"), "issue").limit(10)


def ag_20_progress_view(spark, d):
    o = read(spark, d, "orders")
    return o.groupBy("o_custkey").agg(*[F.sum((F.col("o_orderstatus") == s).cast("long")).alias(n) for s, n in (("O", "todo"), ("F", "done"), ("P", "gaps"))], F.count_distinct("o_orderpriority").alias("actions"))


def wn_08_streaks(spark, d):
    r = requests(spark, d).select("domain", "t", "event_id", bad().alias("bad"))
    return M.streaks(r, "domain", ["t", "event_id"], "bad").groupBy("domain", "bad").agg(F.max("streak").alias("longest"))


def wn_09_trailing_rate(spark, d):
    r = M.trailing_rate(requests(spark, d), "domain", "t", bad(), 86400)
    return r.select("event_id", "n_window", "bad_window")


def wn_10_count_windows(spark, d):
    r = M.count_window(requests(spark, d), "domain", ["t", "event_id"], bad(), 20, 10, 3)
    return r.select("event_id", "bad_20", "bad_10", "bad_3", (F.col("bad_3") == 3).alias("burst"))


def wn_11_latency_rise(spark, d):
    """Latencies of requests that went well, by kind of request: recent p50 against the baseline, which is frozen while it is bad."""
    r = requests(spark, d).where("status BETWEEN 200 AND 299").select("event_id", "event_type", F.floor(F.col("value") * 100).cast("long").alias("v"))
    r = S.latency_rise(r, "event_type", ["event_id"], "v")
    return r.select("event_id", "p50", "cand", "base", F.floor(F.col("ratio") * 1000).cast("long").alias("permille"), (F.col("rise") > 0).alias("risen"))


def wn_12_gaps(spark, d):
    r = requests(spark, d)
    return r.select("event_id", (F.col("t") - F.lag("t").over(Window.partitionBy("domain").orderBy("t", "event_id"))).alias("gap"))


def wn_13_most_in_window(spark, d):
    return M.most_in_window(requests(spark, d), "domain", "t", 3600)


def sm_02_tumbling_batch(spark, d):
    r = requests(spark, d)
    return r.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum(bad().cast("long")).alias("bad")).select(F.unix_timestamp("w.start").alias("start"), "event_type", "n", "bad")


def sm_03_sliding_batch(spark, d):
    r = requests(spark, d)
    return r.groupBy(F.window("ts", "2 hours", "1 hour").alias("w")).agg(F.count("*").alias("n"), F.sum(bad().cast("long")).alias("bad")).select(F.unix_timestamp("w.start").alias("start"), "n", "bad")


def sm_04_sessions_batch(spark, d):
    r = requests(spark, d)
    return r.groupBy(F.session_window("ts", "6 hours").alias("w"), "domain").agg(F.count("*").alias("n")).select("domain", F.unix_timestamp("w.start").alias("start"), "n")


QUERIES = {k: v for k, v in list(globals().items()) if k[:3] in ("ag_", "wn_", "sm_")}
_W = "OVER (PARTITION BY domain ORDER BY t, event_id"
_RC = "CASE WHEN status = 429 THEN 'ratelimit' WHEN status = 400 THEN 'client' WHEN status IN (401, 403) THEN 'auth' WHEN status BETWEEN 500 AND 599 THEN 'server_5xx' WHEN status BETWEEN 300 AND 499 THEN 'fatal' ELSE 'other' END"
_AT = lambda l, q: f"{l}[(least(len({l}) - 1, floor(len({l}) * {q})) + 1)::INT]"
SQL = {
    "ag_05_grouping_sets": f"WITH {REQUESTS}, r AS (SELECT CASE WHEN lim >= 50 THEN 'bulk' ELSE 'light' END AS level, event_type, {_RC} AS layout FROM req) SELECT level, event_type, layout, count(*) AS n FROM r GROUP BY GROUPING SETS ((level), (event_type), (layout))",
    "ag_06_offenders": f"WITH {REQUESTS} SELECT domain, count(*) AS n FROM req WHERE status = 403 GROUP BY 1 HAVING count(*) > 5",
    "ag_07_record_quality": "WITH l AS (SELECT CASE WHEN l_linenumber <> 7 THEN l_orderkey || '-' || (l_linenumber % 3) END AS mms, l_suppkey AS run, l_partkey % 50 = 0 AS bad FROM lineitem) SELECT run, count(*) AS lines, count(*) FILTER (NOT bad) AS valid, count(*) FILTER (NOT bad AND mms IS NULL) AS missing_id, count(DISTINCT mms) FILTER (NOT bad) AS unique, count(mms) FILTER (NOT bad) - count(DISTINCT mms) FILTER (NOT bad) AS duplicate FROM l GROUP BY 1",
    "ag_08_request_log": f"WITH {REQUESTS} SELECT domain, count(*) AS total, count(*) FILTER (lim <= 1) AS probe, count(*) FILTER (lim >= 500) AS full_page, count(*) FILTER (status = 200) AS s200, count(*) FILTER (status = 429) AS s429, count(*) FILTER (status = 503) AS s503 FROM req GROUP BY 1",
    "ag_09_duplicate_work": f"WITH {REQUESTS} SELECT domain, event_type, count(*) AS n FROM req WHERE lim >= 500 GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY n DESC, domain, event_type LIMIT 8",
    "ag_10_distribution": "SELECT event_type, count(value) AS n, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95, quantile_disc(value, 0.99) AS p99, avg(value) AS mean, max(value) AS max FROM events GROUP BY 1",
    "ag_11_end_to_end": "WITH l AS (SELECT l_returnflag AS kind, floor(l_quantity)::BIGINT AS http, l_partkey % 60 AS wait, floor(l_quantity)::BIGINT + l_partkey % 60 AS e2e FROM lineitem) SELECT kind, count(*) AS n, quantile_disc(http, 0.95) AS http_p95, quantile_disc(wait, 0.95) AS wait_p95, quantile_disc(e2e, 0.95) AS e2e_p95, count(*) FILTER (e2e > 90) AS over_n, quantile_disc(e2e, 0.95) > 90 AS p95_over FROM l GROUP BY ROLLUP (kind)",
    "ag_12_active_window": f"WITH {REQUESTS}, b AS (SELECT domain, min(t) FILTER (event_type = 'signup') AS s, max(t) FILTER (event_type = 'purchase') AS e FROM req GROUP BY 1), a AS (SELECT domain, min(t) AS first_t, max(t) AS last_t, count(*) AS n FROM req WHERE event_type IN ('click', 'view') GROUP BY 1) SELECT domain, first_t, last_t, n, last_t - first_t AS span, CASE WHEN s IS NOT NULL THEN greatest(0, first_t - s) END AS startup, CASE WHEN e IS NOT NULL THEN greatest(0, e - last_t) END AS tail FROM a LEFT JOIN b USING (domain)",
    "ag_13_throughput": f"WITH {REQUESTS}, r AS (SELECT domain, count(DISTINCT CASE WHEN status IS NOT NULL THEN (event_type, status) END) AS uniq, count(*) AS n, max(t) - min(t) AS span FROM req GROUP BY 1), p AS (SELECT domain, uniq, n, CASE WHEN span > 0 THEN floor(n * 8640000 / span)::BIGINT END AS per_day_100 FROM r) SELECT p.*, CASE WHEN b.per_day_100 > 0 THEN floor((p.per_day_100 - b.per_day_100) * 1000 / b.per_day_100)::BIGINT END AS delta_permille FROM p LEFT JOIN (SELECT per_day_100 FROM p WHERE domain = 1) b ON true",
    "ag_14_rate_bands": f"WITH {REQUESTS}, h AS (SELECT t // 3600 AS hour, count(*) AS rate, count(*) FILTER (status = 429) AS errors FROM req GROUP BY 1), b AS (SELECT rate, sum(errors) AS errors, count(*) AS hours FROM h GROUP BY 1) SELECT max(rate) FILTER (errors = 0) AS highest_clean, min(rate) FILTER (errors > 0) AS first_errors, sum(hours) AS hours FROM b",
    "ag_16_limiter_snapshot": f"WITH {REQUESTS}, l AS (SELECT * FROM req QUALIFY row_number() OVER (PARTITION BY domain ORDER BY t DESC, event_id DESC) <= 20), g AS (SELECT *, t - lag(t) {_W}) AS gap FROM l) SELECT domain, count(*) AS n, count(*) FILTER {_BAD} AS errors, min(gap) AS gap_min, max(gap) AS gap_max, quantile_disc(gap, 0.5) AS gap_p50, quantile_disc(gap, 0.8) AS gap_p80 FROM g GROUP BY 1",
    "ag_19_issue_rollup": f"WITH {REQUESTS}, r AS (SELECT {_RC} AS issue, event_id FROM req), k AS (SELECT *, row_number() OVER (PARTITION BY issue ORDER BY event_id) AS rn FROM r WHERE issue <> 'other') SELECT issue, count(*) AS n, string_agg(event_id::VARCHAR, ',' ORDER BY event_id) FILTER (rn <= 4) AS examples, issue IN ('auth', 'fatal') AS hard FROM k GROUP BY 1 ORDER BY n DESC, issue LIMIT 10",
    "ag_20_progress_view": "SELECT o_custkey, count(*) FILTER (o_orderstatus = 'O') AS todo, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus = 'P') AS gaps, count(DISTINCT o_orderpriority) AS actions FROM orders GROUP BY 1",
    "wn_08_streaks": f"WITH {REQUESTS}, b AS (SELECT domain, t, event_id, {_BAD} AS bad FROM req), c AS (SELECT *, row_number() {_W}) - row_number() OVER (PARTITION BY domain, bad ORDER BY t, event_id) AS isl FROM b), s AS (SELECT domain, bad, isl, count(*) AS n FROM c GROUP BY 1, 2, 3) SELECT domain, bad, max(n) AS longest FROM s GROUP BY 1, 2",
    "wn_09_trailing_rate": f"WITH {REQUESTS} SELECT event_id, count(*) OVER w AS n_window, sum({_BAD}::INT) OVER w AS bad_window FROM req WINDOW w AS (PARTITION BY domain ORDER BY t RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW)",
    "wn_10_count_windows": f"WITH {REQUESTS}, x AS (SELECT event_id, " + ", ".join(f"sum({_BAD}::INT) {_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS bad_{n}" for n in (20, 10, 3)) + " FROM req) SELECT *, bad_3 = 3 AS burst FROM x",
    "wn_11_latency_rise": f"WITH {REQUESTS}, e AS (SELECT event_id, row_number() OVER c AS n, event_type, list_sort(list(v) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)) AS a, list_sort(list(v) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 255 PRECEDING AND CURRENT ROW)) AS b FROM (SELECT event_id, event_type, floor(value * 100)::BIGINT AS v FROM req WHERE status BETWEEN 200 AND 299) WINDOW c AS (PARTITION BY event_type ORDER BY event_id)), p AS (SELECT event_id, event_type, n, {_AT('a', 0.5)} AS p50, {_AT('b', 0.1)} AS cand FROM e), q AS (SELECT *, coalesce(last_value(CASE WHEN NOT (n >= 30 AND p50 <> 0 AND cand > 0 AND p50 >= 1.5 * cand) THEN cand END IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), cand) AS base FROM p) SELECT event_id, p50, cand, base, CASE WHEN n >= 30 AND base > 0 THEN floor(p50 / base * 1000)::BIGINT END AS permille, coalesce(n >= 30 AND base > 0 AND p50 / base >= 1.8, false) AS risen FROM q",
    "wn_12_gaps": f"WITH {REQUESTS} SELECT event_id, t - lag(t) {_W}) AS gap FROM req",
    "wn_13_most_in_window": f"WITH {REQUESTS}, x AS (SELECT domain, count(*) OVER (PARTITION BY domain ORDER BY t RANGE BETWEEN CURRENT ROW AND 3599 FOLLOWING) AS n FROM req) SELECT domain, max(n) AS most FROM x GROUP BY 1",
    "sm_02_tumbling_batch": f"WITH {REQUESTS} SELECT t // 3600 * 3600 AS start, event_type, count(*) AS n, sum({_BAD}::INT) AS bad FROM req GROUP BY 1, 2",
    "sm_03_sliding_batch": f"WITH {REQUESTS}, x AS (SELECT t // 3600 * 3600 - 3600 * k AS start, {_BAD} AS bad FROM req, (VALUES (0), (1)) v(k)) SELECT start, count(*) AS n, sum(bad::INT) AS bad FROM x GROUP BY 1",
    "sm_04_sessions_batch": f"WITH {REQUESTS}, g AS (SELECT domain, ts, t, event_id, CASE WHEN ts >= lag(ts) OVER (PARTITION BY domain ORDER BY ts, event_id) + INTERVAL 6 HOUR OR lag(ts) OVER (PARTITION BY domain ORDER BY ts, event_id) IS NULL THEN 1 ELSE 0 END AS f FROM req), s AS (SELECT *, sum(f) OVER (PARTITION BY domain ORDER BY ts, event_id) AS sid FROM g) SELECT domain, min(t) AS start, count(*) AS n FROM s GROUP BY domain, sid",
}
