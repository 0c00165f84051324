"""Audit verdicts: JN-13, VD-04, VD-05, UD-01."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.operators import audit as A
from trawl.operators import contract as K
from trawl.plans.audits import AUDIT, COMPAT, LINES, RUN, _audit, _grade, _line_issues, lines, run_of
from trawl.plans.tables import read


class Job(Protocol):
    """A job: its inputs by name, the transformation, and a one-row verdict with a boolean ok."""

    def inputs(self, load: Callable[[str], DataFrame]) -> dict[str, DataFrame]: ...

    def transform(self, inputs: dict[str, DataFrame]) -> DataFrame: ...

    def verdict(self, result: DataFrame) -> DataFrame: ...


def run(job: Job, load: Callable[[str], DataFrame]) -> DataFrame:
    return job.verdict(job.transform(job.inputs(load)))


class SequenceJob:
    """Sequence audit as a job."""

    def __init__(self, spark, d):
        self.spark, self.d = spark, d

    def inputs(self, load):
        return {"audit": _audit(self.spark, self.d), "events": load("events")}

    def transform(self, inputs):
        return A.sequence_issues(inputs["audit"], ["user_id"])

    def verdict(self, result):
        return result.agg(F.count("*").alias("issues"), (F.count("*") == 0).alias("ok"))


def ud_01_job(spark, d):
    return run(SequenceJob(spark, d), lambda name: read(spark, d, name))


def jn_13_post_hoc(spark, d):
    """Files written long after their run's end are hard issues, those from long before its start warnings. Runs: nations; files: customers."""
    runs = read(spark, d, "nation").select(F.col("n_nationkey").alias("run"), (F.col("n_nationkey") * 1000).alias("start"), (F.col("n_nationkey") * 1000 + 5000).alias("end"))
    files = read(spark, d, "customer").select(F.col("c_nationkey").alias("run"), "c_custkey", (F.col("c_nationkey") * 1000 + F.col("c_custkey") * 37 % 7000 - 900).alias("mtime"))
    x = files.join(runs, "run")
    issue = F.when(F.col("mtime") > F.col("end") + 300, "hard").when(F.col("mtime") < F.col("start") - 300, "warn")
    return x.select("c_custkey", issue.alias("issue")).where("issue IS NOT NULL")


#: Link specs: check, what it counts (event and level), how many, whether within the run's window.
LINKS = (("retries", "retry_scheduled", "request", 1, True), ("rounds", "run_start", "process", 1, True), ("restarts", "keeper_restart", "process", 1, False))
#: Thresholds of derived facts: check, item, channel, key, at_least, need. Keys of one item: as many as need says.
SPECS = (("retries", 1, "log", "click", 2, 1), ("rounds", 1, "log_any", "view", 1, 2), ("rounds", 1, "log_any", "purchase", 1, 2), ("rounds", 2, "progress", "view", 1, 1), ("restarts", 1, "log", "error", 1, 1))
#: Length of a run's window, from its first purchase on.
WINDOW = 86_400


def _evidence(spark, d):
    """Facts of each run by channel: log lines and recovery actions by kind of event, as their readings are; and whether the log is an admissible source: last written within the window."""
    t = F.unix_timestamp("ts")
    e = read(spark, d, "events").select(run_of(F.col("user_id"), t).alias("run"), F.col("event_type").alias("key"), "value", t.alias("t"))
    log = e.where("value > 20").groupBy("run", "key").agg(F.count("*").alias("n"))
    actions = e.where("value > 60").groupBy("run", "key").agg(F.count("*").alias("n"))
    facts = log.select("run", F.explode(F.array(F.lit("log"), F.lit("log_any"))).alias("channel"), "key", "n").unionByName(actions.withColumn("channel", F.lit("progress")))
    span = e.groupBy("run").agg(F.min(F.when(F.col("key") == "purchase", F.col("t"))).alias("lo"), F.max("t").alias("last"))
    return facts, span.select("run", F.coalesce(F.col("last") <= F.col("lo") + WINDOW, F.lit(False)).alias("source_ok"))


def vd_05_derived(spark, d):
    """Per run and check: which thresholds of the derived channel hold, and whether the run's source may count."""
    facts, sources = _evidence(spark, d)
    specs = spark.createDataFrame(list(SPECS), "check string, item int, channel string, key string, at_least int, need int")
    return K.derived(facts, specs, sources)


def vd_04_verify(spark, d):
    """Per run: passed, canonical, channel, evidence level, what degrades it and what is missing; read in compat mode, as the lines have older layouts."""
    x = K.read(lines(spark, d), COMPAT, authoritative="sure")
    grade = F.exists("issues", lambda i: K.severity(F.col("rec.layout"), i, COMPAT) == "hard")
    x = x.select("run", "rec.layout", "rec.event", "rec.level", "rec.ts", grade.alias("hard"), F.array_contains("issues", "writer_missing").alias("writerless"))
    t = F.unix_timestamp("ts")
    windows = read(spark, d, "events").where("event_type = 'purchase'").groupBy(run_of(F.col("user_id"), t).alias("run")).agg((F.min(t) - 10).alias("lo"), (F.min(t) + WINDOW).alias("hi"))
    runs = x.groupBy("run").agg(F.count_if("hard").alias("hard"), F.count_if(F.col("layout") == "v2").alias("v2_records"), F.count_if(F.col("layout").isin("keeper", "canonical-v1")).alias("legacy_records"), F.max("writerless").alias("writerless"))
    runs = runs.join(windows.select("run", F.lit(True).alias("window_enforced")), "run", "left").select("run", "hard", "v2_records", "legacy_records", F.coalesce("window_enforced", F.lit(False)).alias("window_enforced"), "writerless")
    met = x.where("layout NOT IN ('aux', 'bad')").join(windows, "run", "left")
    inside = F.coalesce(F.col("ts").between(F.col("lo"), F.col("hi")), F.col("lo").isNull())
    asked = {c: (F.col("event") == name) & (F.coalesce("level", F.lit(level)) == level) & (inside if windowed else F.lit(True)) for c, name, level, _, windowed in LINKS}
    counts = met.groupBy("run").agg(*[F.count_if(cond).alias(c) for c, cond in asked.items()])
    checks = counts.select("run", F.inline(F.array(*[F.struct(F.lit(c).alias("check"), F.lit(windowed).alias("windowed"), (F.col(c) >= n).alias("audit_ok")) for c, _, _, n, windowed in LINKS])))
    checks = checks.join(vd_05_derived(spark, d).select("run", "check", "derived_ok"), ["run", "check"], "left")
    out = K.verify(runs, checks, compat=True)
    return out.select("run", "passed", "canonical_pass", "channel", "evidence_level", F.array_join("degraded", ",").alias("degraded"), F.array_join("missing", ",").alias("missing"))


QUERIES = {k: v for k, v in list(globals().items()) if k[:3] in ("jn_", "vd_", "ud_")}
_FACTS = f"""{AUDIT}, w AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY line) AS no, row_number() OVER (PARTITION BY user_id, seq ORDER BY line) AS again, lag(seq) OVER (PARTITION BY user_id ORDER BY line) AS prev, max(t) OVER (PARTITION BY user_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM au),
  i AS (SELECT user_id, sum((no = 1 AND seq <> 1)::INT + coalesce(again > 1 OR seq < prev OR seq <> prev + 1, false)::INT) AS seq_issues, sum(coalesce(t < high - 1, false)::INT) AS late FROM w GROUP BY 1),
  e AS (SELECT user_id, floor(epoch(ts))::BIGINT AS t, event_type FROM events), b AS (SELECT user_id, min(t) - 10 AS lo, min(t) + 86400 AS hi FROM e WHERE event_type = 'purchase' GROUP BY 1),
  l AS (SELECT b.user_id, count(t) AS linked FROM b LEFT JOIN e ON e.user_id = b.user_id AND t BETWEEN lo AND hi AND event_type = 'click' GROUP BY 1),
  f AS (SELECT user_id, seq_issues, late, linked, derived FROM (SELECT user_id, count(*) FILTER (event_type = 'error') AS derived FROM e GROUP BY 1) LEFT JOIN i USING (user_id) LEFT JOIN l USING (user_id))"""
_DERIVED = f"""sp AS (SELECT * FROM (VALUES {", ".join(map(str, SPECS))}) v("check", item, channel, key, at_least, need)), lg AS (SELECT {RUN} AS run, event_type AS key, count(*) FILTER (value > 20) AS n, count(*) FILTER (value > 60) AS m FROM events GROUP BY 1, 2),
  fa AS (SELECT run, channel, key, n FROM lg, (VALUES ('log'), ('log_any')) v(channel) UNION ALL SELECT run, 'progress', key, m FROM lg),
  so AS (SELECT {RUN} AS run, coalesce(max(floor(epoch(ts))) <= min(floor(epoch(ts))) FILTER (event_type = 'purchase') + {WINDOW}, false) AS ok FROM events GROUP BY 1),
  it AS (SELECT run, "check", item FROM fa JOIN sp USING (channel, key) WHERE n >= at_least GROUP BY run, "check", item, need HAVING count(DISTINCT key) >= need),
  dv AS (SELECT run, "check", coalesce(ok, false) AS derived_ok, CASE WHEN coalesce(ok, false) THEN count(*) ELSE 0 END AS hits, CASE WHEN coalesce(ok, false) THEN 0 ELSE count(*) END AS rejects FROM it LEFT JOIN so USING (run) GROUP BY run, "check", ok)"""
SQL = {
    "ud_01_job": f"WITH {_FACTS} SELECT sum(seq_issues) AS issues, sum(seq_issues) = 0 AS ok FROM i",
    "jn_13_post_hoc": "WITH x AS (SELECT c_custkey, c_custkey * 37 % 7000 - 900 AS m FROM customer JOIN nation ON n_nationkey = c_nationkey) SELECT c_custkey, CASE WHEN m > 5300 THEN 'hard' ELSE 'warn' END AS issue FROM x WHERE m > 5300 OR m < -300",
    "vd_05_derived": f"WITH {_DERIVED} SELECT * FROM dv",
    "vd_04_verify": f"""WITH {LINES}, i AS ({_line_issues(True)}), h AS (SELECT DISTINCT line FROM (SELECT line, {_grade(True)} AS g FROM i) WHERE g = 'hard'), {_DERIVED},
      wd AS (SELECT {RUN} AS run, min(floor(epoch(ts))) - 10 AS lo, min(floor(epoch(ts))) + {WINDOW} AS hi FROM events WHERE event_type = 'purchase' GROUP BY 1),
      y AS (SELECT x.*, wd.lo, wd.hi, CASE layout WHEN 'v2' THEN te ELSE coalesce(te, tl) END AS ts, CASE WHEN layout = 'v2' THEN raw_event ELSE canonical END AS event FROM x LEFT JOIN wd USING (run)),
      r AS (SELECT run, count(*) FILTER (line IN (SELECT line FROM h)) AS hard, count(*) FILTER (layout = 'v2') AS v2, count(*) FILTER (layout IN ('keeper', 'canonical-v1')) AS legacy, bool_or(layout = 'v2' AND writer = '') AS writerless, bool_or(lo IS NOT NULL) AS enforced FROM y GROUP BY 1),
      c0 AS ({" UNION ALL ".join(f"SELECT run, '{c}' AS \"check\", {windowed} AS windowed, count(*) FILTER (event = '{name}' AND coalesce(level, '{level}') = '{level}'{' AND (lo IS NULL OR ts BETWEEN lo AND hi)' if windowed else ''}) >= {n} AS audit_ok FROM y WHERE layout NOT IN ('aux', 'bad') GROUP BY 1" for c, name, level, n, windowed in LINKS)}),
      c AS (SELECT c0.*, coalesce(derived_ok, false) AS der FROM c0 LEFT JOIN dv USING (run, "check")),
      p AS (SELECT run, count(*) AS n, count(*) FILTER (audit_ok) AS by_audit, count(*) FILTER (NOT audit_ok AND der) AS by_derived, bool_or(windowed) AS windowed, coalesce(list("check" ORDER BY "check") FILTER (NOT audit_ok AND NOT der), []) AS missing, coalesce(list('derived_only:' || "check" ORDER BY "check") FILTER (NOT audit_ok AND der), []) AS by_facts FROM c GROUP BY 1),
      z AS (SELECT * REPLACE (coalesce(n, 0) AS n, coalesce(missing, []) AS missing, coalesce(by_facts, []) AS by_facts), coalesce(n = by_audit, false) AS aud, coalesce(n = by_derived, false) AS don, enforced OR NOT coalesce(windowed, false) AS enf FROM r LEFT JOIN p USING (run))
      SELECT run, hard = 0 AND len(missing) = 0 AND n > 0 AS passed, hard = 0 AND aud AND enf AND legacy = 0 AND v2 > 0 AND NOT writerless AS canonical_pass, CASE WHEN aud THEN 'audit' WHEN coalesce(by_audit, 0) > 0 THEN 'mixed' WHEN don THEN 'derived' ELSE 'none' END AS channel, CASE WHEN hard = 0 AND aud AND enf AND legacy = 0 AND v2 > 0 AND NOT writerless THEN 'high' ELSE 'low' END AS evidence_level,
      array_to_string(list_sort(list_concat(by_facts, list_filter([CASE WHEN writerless THEN 'compat_v1_seq_grouping_by_pid' END, CASE WHEN legacy > 0 THEN 'compat_v1_layout' END, CASE WHEN don THEN 'derived_only' END, CASE WHEN NOT enf THEN 'window_not_enforced' END], lambda q: q IS NOT NULL))), ',') AS degraded, array_to_string(missing, ',') AS missing FROM z""",
}
