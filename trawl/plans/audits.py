"""Audit, coverage and convergence queries: CLS-16..20, CLS-23, WN-06/07, JN-05..12/14/20, AG-02/21, VD-01/02."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from trawl.operators import audit as A
from trawl.operators import contract as K
from trawl.operators import coverage as V
from trawl.plans.tables import read


def _audit(spark, d):
    """events as audit lines: group = user, line = event id; sequence numbers with planted gaps, repeats and swaps."""
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    e = read(spark, d, "events").select("user_id", "event_id", F.unix_timestamp("ts").alias("t"), "event_type", "value", n.alias("n"))
    k = F.col("event_id") % 23
    return e.select("user_id", F.col("event_id").alias("line"), F.when(k == 3, F.col("n") + 5).when(k == 7, F.col("n") - 1).otherwise(F.col("n")).cast("long").alias("seq"), F.when(F.col("event_id") % 17 == 0, F.col("t") - 100_000).otherwise(F.col("t")).alias("t"), "event_type", "value")


AUDIT = "au AS (SELECT user_id, event_id AS line, CASE event_id % 23 WHEN 3 THEN n + 5 WHEN 7 THEN n - 1 ELSE n END AS seq, CASE WHEN event_id % 17 = 0 THEN t - 100000 ELSE t END AS t, event_type, value FROM (SELECT *, floor(epoch(ts))::BIGINT AS t, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events))"


def wn_06_sequence_issues(spark, d):
    return A.sequence_issues(_audit(spark, d), ["user_id"])


def wn_06_sequence_groups(spark, d):
    return A.sequence_groups(_audit(spark, d), ["user_id"])


def wn_07_time_regressions(spark, d):
    return A.time_regressions(_audit(spark, d), ["user_id"], "line", "t").select("line", "t", "high")


#: What the audit queries take as known: the contract's own tables, with this data's first day.
CONTRACT = K.Contract(earliest=1_704_100_000)
COMPAT = K.Contract(earliest=1_704_100_000, compat=True)
#: events' types as names of audit events: canonical ones, one alias, and others that stay unknown
AS_EVENTS = {"click": "retry_scheduled", "view": "run_start", "purchase": "keeper_restart", "error": "restart"}


#: Seconds of a run: a user's events of so long are one run's lines.
SPAN = 3 * 86_400
RUN = f"user_id || '-' || (floor(epoch(ts))::BIGINT // {SPAN})"


def run_of(user, t):
    return F.concat_ws("-", user, F.floor(t / SPAN).cast("long"))


def lines(spark, d):
    """events as JSON lines of audit files: run, line, sure (the file is an authoritative one), value. What a line lacks or has wrong goes by the event's own value and time."""
    b, t = F.floor(F.col("value") * 100).cast("long"), F.unix_timestamp("ts")
    e = read(spark, d, "events").select("event_id", "user_id", "event_type", b.alias("b"), t.alias("t"))
    b, t = F.col("b"), F.col("t")
    text = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    part = lambda name, c: F.concat(F.lit(f'"{name}":'), c)
    iso = F.date_format(F.timestamp_seconds(t + F.when(b % 13 == 0, 60).otherwise(0)), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    name = F.coalesce(F.create_map(*[F.lit(x) for kv in AS_EVENTS.items() for x in kv])[F.col("event_type")], F.col("event_type"))
    fields = [
        F.when(b % 29 == 0, part("schema", F.lit('"keeper-audit-v1"'))).when(b % 31 != 0, part("schema", F.lit('"r3-audit-v2"'))),
        F.when(b % 17 != 0, part("ts_epoch", t.cast("string"))).otherwise(part("ts", t.cast("string"))),
        F.when(b % 37 == 0, part("ts_iso", F.lit('"soon"'))).when(b % 53 != 0, part("ts_iso", text(iso))),
        F.when(b % 41 == 0, part("pid", text(F.col("user_id").cast("string")))).otherwise(part("pid", F.col("user_id").cast("string"))),
        F.when(b % 43 != 0, part("writer", text(F.element_at(F.array(*map(F.lit, ("retry", "converge", "keeper"))), (b % 3 + 1).cast("int"))))),
        part("seq", (F.col("event_id") % 200).cast("string")),
        part("level", text(F.element_at(F.array(*map(F.lit, ("request", "block", "process", "request", "process", "odd"))), (b % 6 + 1).cast("int")))),
        part("event", text(name)),
        F.when(b % 19 == 0, part("detail", F.lit('"none"'))).when(b % 23 != 0, part("detail", F.concat(F.lit('{"b":'), b.cast("string"), F.lit("}")))),
    ]
    value = F.when(b % 59 == 0, "torn {").otherwise(F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}")))
    return e.select(run_of(F.col("user_id"), t).alias("run"), F.col("event_id").alias("line"), (b % 47 != 0).alias("sure"), value.alias("value"))


def _read(spark, d, contract=CONTRACT):
    return K.read(lines(spark, d), contract, authoritative="sure")


def cls_16_layout(spark, d):
    return _read(spark, d).groupBy("rec.layout").agg(F.count("*").alias("n"))


def cls_17_alias(spark, d):
    return _read(spark, d).groupBy("rec.layout", "rec.raw_event", "rec.event").agg(F.count("*").alias("n"))


def cls_18_normalised(spark, d):
    r = _read(spark, d).where("rec.layout <> 'bad'")
    return r.select("line", "rec.layout", F.floor("rec.ts").cast("long").alias("ts"), "rec.ts_iso", "rec.pid", "rec.writer", "rec.seq", "rec.level", "rec.event", "rec.detail")


def cls_19_line_issues(spark, d):
    """Violations of strict reading, one row each."""
    return K.each_issue(_read(spark, d), "line")


def cls_20_severity(spark, d):
    """How the issues grade in both modes."""
    out = None
    for mode, contract in (("strict", CONTRACT), ("compat", COMPAT)):
        x = K.each_issue(_read(spark, d, contract), "rec.layout")
        x = x.groupBy(F.lit(mode).alias("mode"), "issue", K.severity(F.col("layout"), F.col("issue"), contract).alias("severity")).agg(F.count("*").alias("n"))
        out = x if out is None else out.unionByName(x)
    return out


_allowed = lambda names: ", ".join(f"'{x}'" for x in names)
_known = {n: [l for m, l in K.EVENTS if m == n] for n in ("retry_scheduled", "run_start", "keeper_restart")}  # noqa: E741
#: The same lines, read by DuckDB's JSON functions: x has a column for each field with its JSON type.
LINES = f"""ev AS (SELECT event_id AS line, user_id, {RUN} AS run, floor(value * 100)::BIGINT AS b, floor(epoch(ts))::BIGINT AS t, coalesce(map {{{', '.join(f"'{k}': '{v}'" for k, v in AS_EVENTS.items())}}}[event_type], event_type) AS name FROM events),
  ln AS (SELECT line, run, b % 47 <> 0 AS sure, CASE WHEN b % 59 = 0 THEN 'torn {{' ELSE '{{' || array_to_string(list_filter([CASE WHEN b % 29 = 0 THEN '"schema":"keeper-audit-v1"' WHEN b % 31 <> 0 THEN '"schema":"r3-audit-v2"' END, CASE WHEN b % 17 <> 0 THEN '"ts_epoch":' || t ELSE '"ts":' || t END,
    CASE WHEN b % 37 = 0 THEN '"ts_iso":"soon"' WHEN b % 53 <> 0 THEN '"ts_iso":"' || strftime(to_timestamp(t + CASE WHEN b % 13 = 0 THEN 60 ELSE 0 END)::TIMESTAMPTZ AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') || '"' END, CASE WHEN b % 41 = 0 THEN '"pid":"' || user_id || '"' ELSE '"pid":' || user_id END,
    CASE WHEN b % 43 <> 0 THEN '"writer":"' || (['retry', 'converge', 'keeper'])[b % 3 + 1] || '"' END, '"seq":' || (line % 200), '"level":"' || (['request', 'block', 'process', 'request', 'process', 'odd'])[b % 6 + 1] || '"', '"event":"' || name || '"',
    CASE WHEN b % 19 = 0 THEN '"detail":"none"' WHEN b % 23 <> 0 THEN '"detail":{{"b":' || b || '}}' END], lambda p: p IS NOT NULL), ',') || '}}' END AS value FROM ev),
  js AS (SELECT line, run, sure, CASE WHEN json_valid(value) THEN value END AS j FROM ln),
  x AS (SELECT line, run, j, CASE WHEN j IS NULL THEN 'bad' WHEN NOT sure THEN 'aux' WHEN j ->> '$.schema' = '{K.SCHEMA}' THEN 'v2' WHEN starts_with(coalesce(j ->> '$.schema', ''), 'keeper-audit') THEN 'keeper' ELSE 'canonical-v1' END AS layout, (j ->> '$.ts_epoch')::BIGINT AS te, (j ->> '$.ts')::BIGINT AS tl, j ->> '$.ts_iso' AS iso,
    try_strptime(j ->> '$.ts_iso', '%Y-%m-%dT%H:%M:%SZ') AS iso_t, CASE WHEN json_type(j, '$.pid') <> 'VARCHAR' THEN (j ->> '$.pid')::BIGINT END AS pid, coalesce(j ->> '$.writer', '') AS writer, (j ->> '$.seq')::BIGINT AS seq, CASE WHEN j ->> '$.level' IN ({_allowed(K.LEVELS)}) THEN j ->> '$.level' END AS level, j ->> '$.event' AS raw_event,
    coalesce(map {{{', '.join(f"'{k}': '{v}'" for k, v in K.ALIASES.items())}}}[j ->> '$.event'], j ->> '$.event') AS canonical, json_type(j, '$.detail') AS dt, j ->> '$.detail' AS detail FROM js)"""
_NAMES = _allowed([n for n, _ in K.EVENTS])
_PAIRED = " OR ".join(f"(raw_event = '{n}' AND level IN ({_allowed(levels)}))" for n, levels in _known.items())


def _line_issues(compat):
    """SQL of the violations: rows (line, layout, issue)."""
    v2 = {
        "ts_epoch_missing_or_not_number": "te IS NULL", "ts_iso_missing": "iso IS NULL", "pid_missing_or_not_int": "pid IS NULL", "writer_missing": "writer = ''", "ts_implausible": f"te < {CONTRACT.earliest}", "legacy_ts_key": "tl IS NOT NULL", "ts_iso_unparsable": "iso IS NOT NULL AND iso_t IS NULL",
        "ts_iso_mismatch": "abs(epoch(iso_t) - te) > 5", "seq_not_positive": "seq < 1", "level_not_in_enum": "level IS NULL", "event_unknown": f"raw_event NOT IN ({_NAMES})", "event_level_mismatch": f"level IS NOT NULL AND raw_event IN ({_NAMES}) AND NOT ({_PAIRED})", "detail_missing": "dt IS NULL", "detail_not_object": "dt <> 'OBJECT'",
    }
    old = {"legacy_layout": "true", "ts_epoch_missing_or_not_number": "te IS NULL", "legacy_ts_key": "tl IS NOT NULL"}
    if compat:
        old = {"legacy_field_missing:pid": "pid IS NULL", "legacy_field_missing:level": "level IS NULL"}
    parts = [f"SELECT line, run, layout, '{k}' AS issue FROM x WHERE layout = 'v2' AND ({c})" for k, c in v2.items()] + [f"SELECT line, run, layout, '{k}' FROM x WHERE layout IN ('keeper', 'canonical-v1') AND ({c})" for k, c in old.items()]
    return " UNION ALL ".join([*parts, "SELECT line, run, layout, 'aux_level_type_conflict' FROM x WHERE layout = 'aux' AND level IS NULL"])


def _grade(compat):
    soft = _allowed([*K.SOFT, *(K.COMPAT_SOFT if compat else ())])
    return f"CASE WHEN layout = 'aux' THEN 'soft' WHEN layout <> 'v2' THEN '{'soft' if compat else 'hard'}' WHEN issue IN ({soft}) THEN 'soft' ELSE 'hard' END"


def cls_23_missing_fields(spark, d):
    """Recommended detail fields that an event lacks."""
    e = read(spark, d, "events").select("event_id", "event_type", "props")
    keys = F.coalesce(F.json_object_keys("props"), F.array().cast("array<string>"))
    want = F.when(F.col("event_type") == "purchase", F.array(F.lit("amount"), F.lit("currency"))).otherwise(F.array(F.lit("page")))
    return e.select("event_type", F.explode(F.array_except(want, keys)).alias("missing")).groupBy("event_type", "missing").agg(F.count("*").alias("n"))


def ag_02_distinct_per_prefix(spark, d):
    li = read(spark, d, "lineitem").select(F.substring(F.col("l_orderkey").cast("string"), 1, 3).alias("prefix"), "l_partkey")
    lines = li.groupBy("prefix", "l_partkey").agg(F.count("*").alias("n"))  # two levels, so that a hot prefix is spread by id first
    return lines.groupBy("prefix").agg(F.sum("n").alias("lines"), F.count("*").alias("uniq"))


def ag_21_prefix_totals(spark, d):
    return V.prefix_totals(read(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("call")), "call", 4)


def jn_08_children(spark, d):
    return V.children_gap(ag_21_prefix_totals(spark, d))


#: The characters a prefix is continued by.
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def jn_09_probe(spark, d):
    """Children of every two-character prefix over the alphabet of 36 characters: hits, proven zeros, undetermined (every seventh key), by join, not by probing."""
    t = ag_21_prefix_totals(spark, d)
    got = t.where("length(prefix) = 3").withColumn("unknown", F.col("total") % 7 == 0)
    return V.probe_outcomes(t.where("length(prefix) = 2").select(F.col("prefix").alias("parent")), got, ALPHABET)


def _ledgers(spark, d):
    o, li = read(spark, d, "orders"), read(spark, d, "lineitem")
    total = (F.col("o_orderkey") % 7).alias("total")
    of = lambda s: o.where(F.col("o_orderstatus") == s).select("o_orderkey", total, F.when(F.col("o_orderkey") % 3 == 0, "branch").otherwise("leaf").alias("type"))
    counts = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count_distinct("l_linenumber").alias("cnt"))
    return of("O"), of("F"), of("P"), counts, o.where("o_orderkey % 31 = 0").select("o_orderkey")


def jn_05_reconcile(spark, d):
    todo, done, gaps, counts, taint = _ledgers(spark, d)
    return V.reconcile(todo, done, gaps, counts, taint, ["o_orderkey"])


def jn_06_recorded_done(spark, d):
    todo, _, _, counts, taint = _ledgers(spark, d)
    x = todo.join(counts, "o_orderkey", "left").join(taint.withColumn("bad", F.lit(True)), "o_orderkey", "left")
    return x.select("o_orderkey", F.coalesce(V.recorded_done(F.col("total"), F.coalesce("cnt", F.lit(0)), F.coalesce("bad", F.lit(False))), F.lit(False)).alias("complete"))


def jn_07_tolerance_marks(spark, d):
    return jn_05_reconcile(spark, d).where("tolerance_mark").select("o_orderkey", "ledger", "total", "cnt")


_RECON = """o AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'todo' WHEN 'F' THEN 'done' WHEN 'P' THEN 'gap' END AS ledger, o_orderkey % 7 AS total, CASE WHEN o_orderkey % 3 = 0 THEN 'branch' ELSE 'leaf' END AS type, o_orderkey % 31 = 0 AS tainted FROM orders WHERE o_orderstatus IN ('O', 'F', 'P')),
  c AS (SELECT l_orderkey AS o_orderkey, count(DISTINCT l_linenumber) AS cnt FROM lineitem GROUP BY 1), x AS (SELECT o.*, coalesce(cnt, 0) AS cnt, total > 0 AND coalesce(cnt, 0) > 0 AND coalesce(cnt, 0) >= total - greatest(2, floor(total * 0.015)) AND NOT tainted AS ok FROM o LEFT JOIN c USING (o_orderkey)),
  r AS (SELECT *, CASE ledger WHEN 'todo' THEN CASE WHEN tainted THEN 'keep_forced' WHEN ok THEN 'todo_to_done' ELSE 'keep' END WHEN 'done' THEN CASE WHEN ok THEN 'keep' WHEN tainted THEN 'torn_to_todo' ELSE 'done_to_todo' END ELSE CASE WHEN type = 'leaf' AND ok THEN 'gap_resolved' ELSE 'keep' END END AS decision FROM x),
  rr AS (SELECT o_orderkey, ledger, total, cnt, decision, (decision IN ('todo_to_done', 'gap_resolved') OR (ledger = 'done' AND decision = 'keep')) AND cnt < total AS tolerance_mark FROM r)"""


def jn_10_integrity(spark, d):
    """Against a reference run, by nation: lost, extra, and up to ten examples of each."""
    o = read(spark, d, "orders").join(read(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("c_nationkey", "o_orderkey")
    ref, cur = o.where("o_orderkey % 10 <> 1"), o.where("o_orderkey % 10 <> 2")
    x = ref.withColumn("r", F.lit(1)).join(cur.withColumn("c", F.lit(1)), ["c_nationkey", "o_orderkey"], "full")
    x = x.select("c_nationkey", "o_orderkey", F.col("c").isNull().alias("lost"), F.col("r").isNull().alias("extra"))
    n = x.groupBy("c_nationkey").agg(F.count(F.when(~F.col("extra"), 1)).alias("expected"), F.sum(F.col("lost").cast("long")).alias("lost"), F.sum(F.col("extra").cast("long")).alias("extra"))
    # the ten smallest are taken before they are gathered
    def ten(what):
        w = Window.partitionBy("c_nationkey").orderBy("o_orderkey")
        top = x.where(what).select("c_nationkey", "o_orderkey", F.row_number().over(w).alias("no")).where("no <= 10")
        return top.groupBy("c_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda v: v.cast("string")), ",").alias(f"{what}_examples"))

    n = n.join(ten("lost"), "c_nationkey", "left").join(ten("extra"), "c_nationkey", "left")
    return n.select("c_nationkey", "lost", "extra", F.round((F.col("expected") - F.col("lost") + F.col("extra")) / F.col("expected"), 6).alias("ratio"), F.coalesce("lost_examples", F.lit("")).alias("lost_examples"), F.coalesce("extra_examples", F.lit("")).alias("extra_examples"))


def jn_11_windows(spark, d):
    e = read(spark, d, "events").select("user_id", "event_id", F.unix_timestamp("ts").alias("t"), "event_type")
    b = e.where("event_type = 'purchase'").groupBy("user_id").agg((F.min("t") - 10).alias("lo"), (F.min("t") + 86_400).alias("hi"))
    return A.in_windows(e, b, "user_id", "t", ["click", "view"], "event_type").select("user_id", "lo", "hi", "n", (F.col("n") >= 1).alias("ok"))


def jn_12_lineage(spark, d):
    """Ids found in evidence texts: strong as id=N, weak as a bare token; and those that are in none."""
    li = read(spark, d, "lineitem")
    text = li.select(F.when(F.col("l_linenumber") == 1, F.concat(F.lit("pid="), F.col("l_suppkey"))).when(F.col("l_linenumber") == 2, F.concat(F.lit("x "), F.col("l_suppkey") * 2)).otherwise("none").alias("t"))
    tokens = text.select(F.explode(F.split("t", r"\s+")).alias("k")).select(F.regexp_extract("k", r"(\d+)$", 1).alias("id"), F.when(F.col("k").startswith("pid="), 2).otherwise(1).alias("s")).where("id <> ''")
    strength = tokens.groupBy(F.col("id").cast("long").alias("s_suppkey")).agg(F.max("s").alias("strength"))
    return read(spark, d, "supplier").select("s_suppkey").join(strength, "s_suppkey", "left").select("s_suppkey", F.coalesce("strength", F.lit(0)).alias("strength"))


def jn_14_recovery(spark, d):
    e = read(spark, d, "events").select("user_id", "event_id", F.unix_timestamp("ts").alias("t"), "event_type")
    x = A.next_event(e, "user_id", ["t", "event_id"], "t", F.col("event_type") == "click").where("event_type = 'purchase'")
    took = F.col("next_t") - F.col("t")
    return x.select("event_id", took.alias("took"), F.coalesce(took <= 86_400, F.lit(False)).alias("within"))


def jn_20_rebuild(spark, d):
    """Ledgers from records alone: seeds as todo with what is recorded."""
    todo, _, _, counts, _ = _ledgers(spark, d)
    return todo.select("o_orderkey", "total").join(counts, "o_orderkey", "left").select("o_orderkey", "total", F.coalesce("cnt", F.lit(0)).alias("cnt"), F.coalesce(V.recorded_done(F.col("total"), F.col("cnt"), F.lit(False)), F.lit(False)).alias("skip"))


def _runs(spark, d):
    o = read(spark, d, "orders")
    return o.groupBy(F.col("o_custkey").alias("run")).agg(F.sum((F.col("o_orderstatus") == "O").cast("long") * (F.col("o_custkey") % 3 == 0).cast("long")).alias("todo"), F.sum((F.col("o_orderstatus") == "P").cast("long")).alias("open_gaps"), F.sum(((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 2 == 0)).cast("long")).alias("terminal_gaps"), (F.col("run") % 4 == 0).cast("long").alias("fixed"))


def vd_01_convergence(spark, d):
    return V.convergence(_runs(spark, d))


def vd_02_gap_budget(spark, d):
    """Repair attempts of open gaps: resolved by new coverage, or terminal at the second attempt."""
    _, _, gaps, counts, taint = _ledgers(spark, d)
    x = V.reconcile(gaps.limit(0), gaps.limit(0).select("o_orderkey", "total", "type"), gaps, counts, taint, ["o_orderkey"])
    attempts = F.col("o_orderkey") % 3 + 1
    ok = F.col("decision") == "gap_resolved"
    return x.select("o_orderkey", attempts.alias("attempts"), ok.alias("resolved"), (~ok & (attempts >= 2)).alias("terminal"))


QUERIES = {k: v for k, v in list(globals().items()) if k[:3] in ("wn_", "ag_", "jn_", "vd_") or k[:4] == "cls_"}
_TOT = "tot AS (SELECT substr(o_orderkey::VARCHAR, 1, k) AS prefix, count(*) AS total FROM orders, (VALUES (1), (2), (3), (4)) v(k) WHERE k <= length(o_orderkey::VARCHAR) GROUP BY 1)"
SQL = {
    "wn_06_sequence_issues": f"WITH {AUDIT}, w AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY line) AS no, row_number() OVER (PARTITION BY user_id, seq ORDER BY line) AS again, lag(seq) OVER (PARTITION BY user_id ORDER BY line) AS prev FROM au) SELECT user_id, line, seq, 'seq_group_not_from_1' AS issue FROM w WHERE no = 1 AND seq <> 1 UNION ALL SELECT user_id, line, seq, CASE WHEN again > 1 THEN 'seq_duplicate' WHEN seq < prev THEN 'seq_reorder' ELSE 'seq_gap' END FROM w WHERE again > 1 OR seq < prev OR seq <> prev + 1",
    "wn_06_sequence_groups": f"WITH {AUDIT}, w AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY line) AS no FROM au) SELECT user_id, count(*) AS n, arg_min(seq, line) AS seq_first, arg_max(seq, line) AS seq_last, bool_and(seq = no) AS ok FROM w GROUP BY 1",
    "wn_07_time_regressions": f"WITH {AUDIT}, w AS (SELECT *, max(t) OVER (PARTITION BY user_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM au) SELECT line, t, high FROM w WHERE t < high - 1",
    "cls_16_layout": f"WITH {LINES} SELECT layout, count(*) AS n FROM x GROUP BY 1",
    "cls_17_alias": f"WITH {LINES} SELECT layout, raw_event, CASE WHEN layout = 'v2' THEN raw_event ELSE canonical END AS event, count(*) AS n FROM x GROUP BY 1, 2, 3",
    "cls_18_normalised": f"WITH {LINES} SELECT line, layout, CASE layout WHEN 'v2' THEN te WHEN 'aux' THEN tl ELSE coalesce(te, tl) END AS ts, CASE WHEN layout <> 'aux' THEN iso END AS ts_iso, pid, writer, seq, CASE WHEN layout = 'aux' THEN 'process' ELSE level END AS level, CASE WHEN layout = 'v2' THEN raw_event ELSE canonical END AS event, CASE WHEN layout = 'aux' THEN '{{}}' WHEN dt = 'OBJECT' THEN detail WHEN layout <> 'v2' THEN '{{}}' END AS detail FROM x WHERE layout <> 'bad'",
    "cls_19_line_issues": f"WITH {LINES}, i AS ({_line_issues(False)}) SELECT line, issue FROM i",
    "cls_20_severity": f"WITH {LINES}, s AS ({_line_issues(False)}), c AS ({_line_issues(True)}) SELECT 'strict' AS mode, issue, {_grade(False)} AS severity, count(*) AS n FROM s GROUP BY ALL UNION ALL SELECT 'compat', issue, {_grade(True)}, count(*) FROM c GROUP BY ALL",
    "cls_23_missing_fields": "WITH e AS (SELECT event_type, coalesce(json_keys(props::JSON), []) AS keys FROM events), m AS (SELECT event_type, unnest(list_filter(CASE WHEN event_type = 'purchase' THEN ['amount', 'currency'] ELSE ['page'] END, lambda x: NOT list_contains(keys, x))) AS missing FROM e) SELECT event_type, missing, count(*) AS n FROM m GROUP BY 1, 2",
    "ag_02_distinct_per_prefix": "SELECT substr(l_orderkey::VARCHAR, 1, 3) AS prefix, count(*) AS lines, count(DISTINCT l_partkey) AS uniq FROM lineitem GROUP BY 1",
    "ag_21_prefix_totals": f"WITH {_TOT} SELECT prefix, total FROM tot",
    "jn_08_children": f"WITH {_TOT}, k AS (SELECT substr(prefix, 1, length(prefix) - 1) AS prefix, sum(total) AS covered, count(*) AS children FROM tot WHERE length(prefix) > 1 GROUP BY 1) SELECT prefix, total, covered, children, total - covered AS gap, total - covered > greatest(100, floor(total * 0.02)) AS recorded FROM tot JOIN k USING (prefix)",
    "jn_09_probe": f"WITH {_TOT}, kids AS (SELECT prefix AS parent, prefix || c AS prefix FROM tot, (SELECT unnest(string_split('{ALPHABET}', '')) AS c) WHERE length(prefix) = 2), x AS (SELECT parent, sum((total IS NULL)::INT) AS zero, sum(coalesce(total % 7 = 0, false)::INT) AS undetermined, sum(coalesce(total % 7 <> 0, false)::INT) AS hit, coalesce(sum(total) FILTER (total % 7 <> 0), 0) AS covered FROM kids LEFT JOIN tot USING (prefix) GROUP BY 1) SELECT *, hit + zero = 0 AND undetermined > 0 AS all_dead, undetermined > 0 AS incomplete FROM x",
    "jn_05_reconcile": f"WITH {_RECON} SELECT * FROM rr",
    "jn_06_recorded_done": f"WITH {_RECON} SELECT o_orderkey, ok AS complete FROM r WHERE ledger = 'todo'",
    "jn_07_tolerance_marks": f"WITH {_RECON} SELECT o_orderkey, ledger, total, cnt FROM rr WHERE tolerance_mark",
    "jn_10_integrity": """WITH o AS (SELECT c_nationkey, o_orderkey, o_orderkey % 10 = 2 AS lost, o_orderkey % 10 = 1 AS extra FROM orders JOIN customer ON o_custkey = c_custkey)
      SELECT c_nationkey, count(*) FILTER (lost) AS lost, count(*) FILTER (extra) AS extra, round((count(*) FILTER (NOT extra) - count(*) FILTER (lost) + count(*) FILTER (extra)) / count(*) FILTER (NOT extra), 6) AS ratio,
      coalesce(array_to_string(list_sort(list(o_orderkey) FILTER (lost))[1:10], ','), '') AS lost_examples, coalesce(array_to_string(list_sort(list(o_orderkey) FILTER (extra))[1:10], ','), '') AS extra_examples FROM o GROUP BY 1""",
    "jn_11_windows": "WITH e AS (SELECT user_id, floor(epoch(ts))::BIGINT AS t, event_type FROM events), b AS (SELECT user_id, min(t) - 10 AS lo, min(t) + 86400 AS hi FROM e WHERE event_type = 'purchase' GROUP BY 1) SELECT b.user_id, lo, hi, count(t) AS n, count(t) >= 1 AS ok FROM b LEFT JOIN e ON e.user_id = b.user_id AND t BETWEEN lo AND hi AND event_type IN ('click', 'view') GROUP BY 1, 2, 3",
    "jn_12_lineage": "WITH t AS (SELECT l_suppkey AS id, 2 AS s FROM lineitem WHERE l_linenumber = 1 UNION ALL SELECT l_suppkey * 2, 1 FROM lineitem WHERE l_linenumber = 2), m AS (SELECT id, max(s) AS s FROM t GROUP BY 1) SELECT s_suppkey, coalesce(s, 0) AS strength FROM supplier LEFT JOIN m ON id = s_suppkey",
    "jn_14_recovery": "WITH e AS (SELECT event_id, user_id, floor(epoch(ts))::BIGINT AS t, event_type FROM events), x AS (SELECT *, first_value(CASE WHEN event_type = 'click' THEN t END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nt FROM e) SELECT event_id, nt - t AS took, coalesce(nt - t <= 86400, false) AS within FROM x WHERE event_type = 'purchase'",
    "jn_20_rebuild": f"WITH {_RECON} SELECT o_orderkey, total, cnt, total > 0 AND cnt > 0 AND cnt >= total - greatest(2, floor(total * 0.015)) AS skip FROM x WHERE ledger = 'todo'",
    "vd_01_convergence": """WITH r AS (SELECT o_custkey AS run, sum(CASE WHEN o_orderstatus = 'O' AND o_custkey % 3 = 0 THEN 1 ELSE 0 END) AS todo, count(*) FILTER (o_orderstatus = 'P') AS open_gaps, count(*) FILTER (o_orderstatus = 'P' AND o_orderkey % 2 = 0) AS terminal_gaps, CASE WHEN o_custkey % 4 = 0 THEN 1 ELSE 0 END AS fixed FROM orders GROUP BY 1, o_custkey % 4),
      x AS (SELECT *, CASE WHEN todo > 0 THEN 'todo-pending' WHEN open_gaps = 0 THEN 'no-todo-no-open-gaps' WHEN fixed > 0 THEN 'repair-progress' WHEN terminal_gaps = open_gaps THEN 'repair-budget-exhausted' ELSE 'repair-budget-left' END AS reason FROM r)
      SELECT *, CASE WHEN reason = 'no-todo-no-open-gaps' THEN 'done' ELSE 'continue' END AS decided, reason IN ('no-todo-no-open-gaps', 'repair-budget-exhausted') AS terminal, CASE reason WHEN 'no-todo-no-open-gaps' THEN 0 WHEN 'repair-budget-exhausted' THEN 3 END AS exit_code FROM x""",
    "vd_02_gap_budget": f"WITH {_RECON} SELECT o_orderkey, o_orderkey % 3 + 1 AS attempts, decision = 'gap_resolved' AS resolved, decision <> 'gap_resolved' AND o_orderkey % 3 + 1 >= 2 AS terminal FROM rr WHERE ledger = 'gap'",
}
