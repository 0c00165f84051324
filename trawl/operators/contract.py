"""Audit contracts from tables: layouts, aliases, events with their levels, severities, link specs and thresholds are data.

read() takes any table of JSON lines and gives each line's normalised record and its violations, compiled from the contract's
tables into one projection. severity() grades them by mode. derived() and verify() join per-run counts with spec tables: how a run
passes, through which channel, and what degrades it. Nothing here is bound to a query's table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names and bounds of the audit contract.
SCHEMA = "r3-audit-v2"
LEVELS = ("request", "block", "process")
EARLIEST, AHEAD, APART = 1_735_689_600, 600, 5.0
REQUEST_EVENTS = "retry_scheduled retry_exhausted error_classified rate_limited cooldown_enter circuit_open circuit_close request_failed throttle_adjust throttle_snapshot error_recovered"
BLOCK_EVENTS = """probe_all_dead repair_round_enter convergence_decision stall_detected graceful_stop run_start run_end probe_incomplete probe_partial_dead probe_retry probe_enumeration_gap repair_round_exit repair_round_result
repair_exhausted stall_cleared gap_recorded children_discovered output_dir_recreated records_write_deferred records_write_dropped progress_write_failed convergence_report_failed short_write_detected records_repair records_tail_repaired big_gap"""
PROCESS_EVENTS = """keeper_restart keeper_adopt_refused singleton_conflict heartbeat_stall keeper_exit keeper_start keeper_stop keeper_abort keeper_adopt adopt adopt_unverified singleton_acquired singleton_released heartbeat heartbeat_class
tolerance_done process_dead process_alive restart_failed restart_backoff restart_flapping restart_dry_run guard_suppressed detector_ambiguous env_probe env_probe_fail env_changed pidfile_stale pidfile_untrusted deadline_breached
progress_recovered checkpoint_restore dir_recreated mem_level_change gate_close gate_open mem_abort keeper_signal stall_kill stall_restart_refused state_imported cycle_aborted config_rail_override config_rail_refused config_warning
selftest_case selftest_result run_start run_end graceful_stop stall_detected dir_recreate keeper_exit_observed keeper_lock_unavailable keeper_lock_rotated keeper_job_stop keeper_job_halt keeper_job_resume keeper_terminal_report_stale
keeper_terminal_channel_conflict keeper_restart_budget keeper_restart_budget_exhausted spawn_refused"""
EVENTS = tuple((name, level) for level, names in zip(LEVELS, (REQUEST_EVENTS, BLOCK_EVENTS, PROCESS_EVENTS), strict=True) for name in names.split())
ALIASES = {
    "restart": "keeper_restart", "restart_dry_run": "keeper_restart", "adopt": "keeper_adopt", "deadline_breach": "deadline_breached", "probe_incomplete": "probe_partial_dead", "output_dir_recreated": "dir_recreated", "trim": "mem_abort",
    "level-up": "mem_level_change", "level-down": "mem_level_change", "gate-close": "gate_close", "gate-open": "gate_open", "abort": "mem_abort", "abort-degraded": "mem_abort", "summary": "mem_level_change", "unit": "gate_close",
    "gate-timeout": "gate_close", "gate-install": "gate_open", "gate-uninstall": "gate_open", "error": "mem_level_change", "stop": "mem_abort", "start": "mem_level_change",
}
SOFT = ("event_unknown", "event_level_mismatch", "ts_iso_mismatch", "ts_iso_unparsable", "ts_not_monotonic", "detail_fields_missing", "legacy_ts_key_tolerated", "aux_level_type_conflict")
COMPAT_SOFT = ("writer_missing", "seq_duplicate", "seq_gap", "seq_reorder", "seq_group_not_from_1")
#: field, its type, what its absence is called
REQUIRED = (
    ("ts_epoch", "number", "ts_epoch_missing_or_not_number"), ("ts_iso", "text", "ts_iso_missing"), ("pid", "whole", "pid_missing_or_not_int"), ("writer", "text", "writer_missing"), ("seq", "whole", "seq_missing_or_not_int"), ("event", "name", "event_missing"),
)


@dataclass(frozen=True)
class Contract:
    schema: str = SCHEMA
    levels: tuple[str, ...] = LEVELS
    events: tuple[tuple[str, str], ...] = EVENTS
    aliases: dict[str, str] = field(default_factory=lambda: ALIASES)
    required: tuple[tuple[str, str, str], ...] = REQUIRED
    earliest: float = EARLIEST
    soft: tuple[str, ...] = SOFT
    compat_soft: tuple[str, ...] = COMPAT_SOFT
    #: lines without the schema are adapted and only warned of
    compat: bool = False
    allow_legacy_ts: bool = False
    strict_unknown: bool = False
    strict_aux: bool = False


FIELDS = ("schema", "ts_epoch", "ts", "ts_iso", "pid", "keeper_pid", "writer", "seq", "level", "event", "r3_event", "detail", "evidence", "run", "run_id")


class Line:
    """Typed access to the fields of JSON lines. A line is parsed once, and each field's type and value taken once, in projections of their own."""

    def __init__(self, lines: DataFrame, value: str):
        x = lines.withColumn("_v", F.try_parse_json(F.col(value)))
        x = x.withColumns({f"_x_{f}": F.try_variant_get("_v", f"$.{f}", "variant") for f in FIELDS}).withColumn("_object", F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False)))
        self.df = x.withColumns({f"_t_{f}": F.coalesce(F.schema_of_variant(f"_x_{f}"), F.lit("none")) for f in FIELDS})

    def has(self, name: str) -> Column:
        return F.col(f"_x_{name}").isNotNull()

    def type(self, name: str) -> Column:
        return F.col(f"_t_{name}")

    def given(self, name: str) -> Column:
        """The key is there with a value other than null."""
        return ~self.type(name).isin("none", "VOID")

    def text(self, name: str) -> Column:
        return F.when(self.type(name) == "STRING", F.try_variant_get(f"_x_{name}", "$", "string"))

    def whole(self, name: str) -> Column:
        return F.when(self.type(name) == "BIGINT", F.try_variant_get(f"_x_{name}", "$", "bigint"))

    def number(self, name: str) -> Column:
        return F.when(self.type(name).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.try_variant_get(f"_x_{name}", "$", "double"))

    def object(self, name: str) -> Column:
        return F.when(self.type(name).startswith("OBJECT"), F.to_json(f"_x_{name}"))

    def as_type(self, name: str, kind: str) -> Column:
        if kind == "text":
            return F.when(F.trim(self.text(name)) != "", self.text(name))
        return F.when(self.text(name) != "", self.text(name)) if kind == "name" else getattr(self, kind)(name)

    def time(self, name: str) -> Column:
        """Seconds: a number, or a text in ISO form."""
        return F.coalesce(self.number(name), seconds(self.text(name)))


def seconds(text: Column) -> Column:
    t = F.try_to_timestamp(text)
    return F.unix_micros(t) / 1e6


def _map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) if not isinstance(x, (list, tuple)) else F.array(*map(F.lit, x)) for kv in pairs.items() for x in kv])


def _issues(*checks: tuple[Column | None, str]) -> Column:
    return F.array_compact(F.array(*[F.when(c, kind) for c, kind in checks if c is not None], F.lit(None).cast("string")))


def read(lines: DataFrame, contract: Contract | None = None, now: float | None = None, value: str = "value", authoritative: str | None = None) -> DataFrame:
    """lines with rec (layout, ts, ts_iso, pid, writer, seq, level, event, detail, run, raw_event) and issues (kinds); lines that are no JSON object have layout 'bad'.

    Layouts: v2 by its schema; keeper and canonical-v1 for other lines; aux for lines of files that aren't authoritative. now: the latest time that is plausible, less AHEAD."""
    c, x = contract or Contract(), Line(lines, value)
    levels, allowed = F.array(*map(F.lit, c.levels)), {}
    for name, level in c.events:
        allowed.setdefault(name, []).append(level)
    allowed = _map(allowed)
    known = {"_level": F.when(F.array_contains(levels, x.text("level")), x.text("level")), "_event": x.as_type("event", "name"), "_ts": x.number("ts_epoch"), "_iso": x.as_type("ts_iso", "text"), "_seq": x.whole("seq"), "_iso_t": seconds(x.as_type("ts_iso", "text"))}
    x.df = x.df.withColumns(known).withColumn("_allowed", allowed[F.col("_event")])
    level, event, ts, iso, seq, iso_t, allowed = (F.col(n) for n in (*known, "_allowed"))
    schema = F.coalesce(x.text("schema"), F.lit(""))
    aux = ~F.coalesce(F.col(authoritative), F.lit(True)) if authoritative else F.lit(False)
    x.df = x.df.withColumn("_layout", F.when(F.col("_object"), F.when(aux, "aux").when(schema == c.schema, "v2").when(schema.startswith("keeper-audit") | x.has("keeper_pid") | x.has("r3_event"), "keeper").otherwise("canonical-v1")).otherwise("bad"))
    layout = F.col("_layout")
    renamed = lambda e: F.coalesce(_map(c.aliases)[e], e)

    # v2
    known = allowed.isNotNull()
    late = ts > now + AHEAD if now is not None else None
    v2 = _issues(
        *[(x.as_type(f, kind).isNull(), name) for f, kind, name in c.required],
        (ts < c.earliest, "ts_implausible"), (late, "ts_in_future"), (x.has("ts"), "legacy_ts_key_tolerated" if c.allow_legacy_ts else "legacy_ts_key"),
        (iso.isNotNull() & iso_t.isNull(), "ts_iso_unparsable"), (F.abs(iso_t - ts) > APART, "ts_iso_mismatch"),
        (seq < 1, "seq_not_positive"), (level.isNull(), "level_not_in_enum"), (event.isNotNull() & ~known, "strict_unknown_event" if c.strict_unknown else "event_unknown"),
        (known & level.isNotNull() & ~F.array_contains(allowed, level), "event_level_mismatch"), (~x.given("detail"), "detail_missing"), (x.given("detail") & x.object("detail").isNull(), "detail_not_object"),
    )
    # older layouts: adapted in compat mode; else three kinds say it all
    keeper = layout == "keeper"
    raw = F.when(keeper, F.coalesce(x.as_type("r3_event", "name"), x.text("event"))).otherwise(x.text("event"))
    old = {"ts": F.coalesce(F.when(x.given("ts_epoch"), x.time("ts_epoch")), x.time("ts")), "pid": F.coalesce(x.whole("pid"), x.whole("keeper_pid")), "seq": seq, "level": level, "event": F.nullif(renamed(raw), F.lit(""))}
    if c.compat:
        legacy = _issues((old["ts"].isNull(), "legacy_ts_unparsable"), *[(v.isNull(), f"legacy_field_missing:{k}") for k, v in old.items()])
    else:
        legacy = _issues((F.lit(True), "legacy_layout"), (~x.given("ts_epoch"), "ts_epoch_missing_or_not_number"), (None if c.allow_legacy_ts else x.has("ts"), "legacy_ts_key"))
    aux_issues = _issues((x.has("level") & level.isNull(), "aux_level_type_conflict"))

    by = lambda v2, old, aux: F.when(layout == "v2", v2).when(layout == "aux", aux).when(layout != "bad", old)
    name = x.text("event")
    rec = F.struct(
        layout.alias("layout"), by(ts, old["ts"], x.time("ts")).alias("ts"), by(iso, F.coalesce(x.as_type("ts_iso", "text"), x.text("ts")), x.text("ts")).alias("ts_iso"), by(x.whole("pid"), old["pid"], x.whole("pid")).alias("pid"),
        F.coalesce(F.trim(x.text("writer")), F.lit("")).alias("writer"), seq.alias("seq"), by(level, level, F.lit(c.levels[-1])).alias("level"), by(event, old["event"], renamed(name)).alias("event"),
        by(x.object("detail"), F.coalesce(x.object("detail"), x.object("evidence"), F.lit("{}")), F.lit("{}")).alias("detail"), F.coalesce(x.text("run"), x.text("run_id")).alias("run"), by(name, raw, name).alias("raw_event"),
    )
    out = x.df.withColumn("rec", rec).withColumn("issues", F.coalesce(by(v2, legacy, aux_issues), F.array().cast("array<string>")))
    return out.select(*lines.columns, "rec", "issues")


def each_issue(read_: DataFrame, *keep: str | Column) -> DataFrame:
    """Columns of read lines, and issue: one row for each violation. The outer form of explode keeps Spark from taking the checks apart as a filter before it."""
    return read_.select(*keep, F.explode_outer("issues").alias("issue")).where("issue IS NOT NULL")


def severity(layout: Column, kind: Column, contract: Contract) -> Column:
    """'hard' or 'soft' of an issue kind on a line of a layout."""
    base = F.substring_index(kind, ":", 1)
    soft = F.when(layout == "aux", F.lit(not contract.strict_aux)).when(layout != "v2", F.lit(contract.compat))
    return F.when(soft.otherwise(base.isin(*contract.soft, *(contract.compat_soft if contract.compat else ()))), "soft").otherwise("hard")


def derived(facts: DataFrame, specs: DataFrame, sources: DataFrame, run: str = "run") -> DataFrame:
    """Per run and check: derived_ok, and hits and rejects (items whose thresholds hold, by whether the run's source is admissible).

    facts: run, channel, key, n (log lines with numbers, or recovery actions). specs: check, item, channel, key, at_least, need: an item holds when
    need of its keys reach at_least. sources: run, source_ok. Specs are joined by (channel, key), so facts meet only what asks for them."""
    met = facts.join(specs, ["channel", "key"]).where("n >= at_least").groupBy(run, "check", "item", "need").agg(F.count_distinct("key").alias("keys"))
    held = met.where("keys >= need").groupBy(run, "check").agg(F.count("*").alias("items"))
    ok = F.coalesce("source_ok", F.lit(False))
    return held.join(sources, run, "left").select(run, "check", ok.alias("derived_ok"), F.when(ok, F.col("items")).otherwise(0).alias("hits"), F.when(ok, 0).otherwise(F.col("items")).alias("rejects"))


def verify(runs: DataFrame, checks: DataFrame, compat: bool = False, run: str = "run") -> DataFrame:
    """Per run: pass, canonical_pass, channel (audit, mixed, derived, none), evidence_level, degraded, missing.

    runs: run, hard, v2_records, legacy_records, window_enforced, writerless (a line without writer was grouped by pid). checks: run, check, windowed, audit_ok,
    derived_ok. All checks by audit: audit; some: mixed; none but all derived: derived. Each lower step of the ladder is named in degraded."""
    a, d = F.coalesce("audit_ok", F.lit(False)), F.coalesce("derived_ok", F.lit(False))
    per = checks.groupBy(run).agg(
        F.count("*").alias("n"), F.count_if(a).alias("by_audit"), F.count_if(~a & d).alias("by_derived"), F.max("windowed").alias("windowed"),
        F.sort_array(F.collect_list(F.when(~a & ~d, F.col("check")))).alias("missing"), F.sort_array(F.collect_list(F.when(~a & d, F.concat(F.lit("derived_only:"), "check")))).alias("only"),
    )
    none = F.array().cast("array<string>")
    x = runs.join(per, run, "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("missing", F.coalesce("missing", none)).withColumn("only", F.coalesce("only", none))
    all_audit, derived_only = (F.col("n") > 0) & (F.col("by_audit") == F.col("n")), (F.col("n") > 0) & (F.col("by_derived") == F.col("n"))
    channel = F.when(all_audit, "audit").when(F.coalesce(F.col("by_audit") > 0, F.lit(False)), "mixed").when(derived_only, "derived").otherwise("none")
    enforced = F.col("window_enforced") | ~F.coalesce("windowed", F.lit(False))
    writerless = F.col("writerless") if compat else F.lit(False)
    passed = (F.col("hard") == 0) & (F.size("missing") == 0) & (F.col("n") > 0)
    canonical = F.coalesce((F.col("hard") == 0) & all_audit & enforced & (F.col("legacy_records") == 0) & (F.col("v2_records") > 0) & ~writerless, F.lit(False))
    degraded = F.array_compact(F.array(F.when(writerless, "compat_v1_seq_grouping_by_pid"), F.when(F.lit(compat) & (F.col("legacy_records") > 0), "compat_v1_layout"), F.when(derived_only, "derived_only"), F.when(~enforced, "window_not_enforced")))
    return x.select(run, passed.alias("passed"), canonical.alias("canonical_pass"), channel.alias("channel"), F.when(canonical, "high").otherwise("low").alias("evidence_level"), F.sort_array(F.concat(degraded, "only")).alias("degraded"), "missing")
