"""Coverage of key hierarchies, and ledgers against records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.functions import text as T

LEAF_MAX = 490


def prefix_totals(df: DataFrame, key: str, longest: int) -> DataFrame:
    """prefix, total for every prefix of up to so many characters: exploded and counted, map-side combined; no starts-with join."""
    p = df.select(F.explode(F.sequence(F.lit(1), F.least(F.length(key), F.lit(longest)))).alias("k"), key)
    return p.groupBy(F.expr(f"substring({key}, 1, k)").alias("prefix")).agg(F.count("*").alias("total"))


def children_gap(totals: DataFrame) -> DataFrame:
    """Each prefix that has children: total, covered by its children, gap, and whether the gap is worth recording."""
    kids = totals.where(F.length("prefix") > 1).groupBy(F.expr("substring(prefix, 1, length(prefix) - 1)").alias("prefix")).agg(F.sum("total").alias("covered"), F.count("*").alias("children"))
    x = totals.join(kids, "prefix")
    gap = F.col("total") - F.col("covered")
    return x.select("prefix", "total", "covered", "children", gap.alias("gap"), (gap > T.branch_threshold(F.col("total"))).alias("recorded"))


def probe_outcomes(parents: DataFrame, results: DataFrame, alphabet: str, parent: str = "parent") -> DataFrame:
    """A probe of each parent's children over an alphabet: hit, zero and undetermined children, covered (the hits' totals), all_dead, incomplete.

    results: prefix, total, unknown (the probe failed); a child without a result is a proven zero. Children are made by exploding the alphabet, and met by an equality join."""
    kids = parents.select(parent, F.explode(F.array(*map(F.lit, alphabet))).alias("_c")).withColumn("prefix", F.concat(parent, "_c"))
    unknown, hit = F.coalesce("unknown", F.lit(False)), F.coalesce(~F.col("unknown") & (F.col("total") > 0), F.lit(False))
    x = kids.join(results.select("prefix", "total", "unknown"), "prefix", "left").groupBy(parent).agg(
        F.count_if(hit).alias("hit"), F.count_if(~hit & ~unknown).alias("zero"), F.count_if(unknown).alias("undetermined"), F.coalesce(F.sum(F.when(hit, F.col("total"))), F.lit(0)).alias("covered"))
    return x.select("*", ((F.col("hit") + F.col("zero") == 0) & (F.col("undetermined") > 0)).alias("all_dead"), (F.col("undetermined") > 0).alias("incomplete"))


def recorded_done(total, cnt, tainted):
    """Whether records alone show that a leaf is complete."""
    return (total > 0) & (total <= LEAF_MAX) & ~tainted & (cnt > 0) & (cnt >= total - T.leaf_tolerance(total))


def reconcile(todo: DataFrame, done: DataFrame, gaps: DataFrame, counts: DataFrame, taint: DataFrame, key: list[str]) -> DataFrame:
    """Decision for every ledger row: (key, ledger, total, cnt, decision). Ledgers have total; gaps also type; taint has the key only.

    A tainted todo is kept by force, a todo that records cover is done; a done row that they don't cover, or a tainted one, is requeued; a leaf gap that they cover is resolved."""
    rows = todo.select(*key, F.lit("todo").alias("ledger"), "total", F.lit(None).cast("string").alias("type"))
    rows = rows.unionByName(done.select(*key, F.lit("done").alias("ledger"), "total", F.lit(None).cast("string").alias("type"))).unionByName(gaps.select(*key, F.lit("gap").alias("ledger"), "total", "type"))
    rows = rows.join(counts.select(*key, "cnt"), key, "left").join(taint.select(*key).distinct().withColumn("tainted", F.lit(True)), key, "left")
    rows = rows.withColumn("cnt", F.coalesce("cnt", F.lit(0))).withColumn("tainted", F.coalesce("tainted", F.lit(False)))
    total, cnt = F.col("total"), F.col("cnt")
    enough = (total > 0) & (cnt > 0) & (cnt >= total - T.leaf_tolerance(total)) & ~F.col("tainted")
    decision = (
        F.when((F.col("ledger") == "todo") & F.col("tainted"), "keep_forced")
        .when((F.col("ledger") == "todo") & F.coalesce(recorded_done(total, cnt, F.col("tainted")), F.lit(False)), "todo_to_done")
        .when(F.col("ledger") == "todo", "keep")
        .when((F.col("ledger") == "done") & F.coalesce(enough, F.lit(False)), "keep")
        .when((F.col("ledger") == "done") & F.col("tainted"), "torn_to_todo")
        .when(F.col("ledger") == "done", "done_to_todo")
        .when((F.col("type") == "leaf") & F.coalesce(enough, F.lit(False)), "gap_resolved")
        .otherwise("keep")
    )
    tolerated = decision.isin("todo_to_done", "gap_resolved") | ((F.col("ledger") == "done") & (decision == "keep"))
    return rows.select(*key, "ledger", "total", "cnt", decision.alias("decision"), (tolerated & (cnt < total)).alias("tolerance_mark"))


def convergence(runs: DataFrame) -> DataFrame:
    """runs: run, todo, open_gaps, terminal_gaps, fixed -> decided, terminal, exit_code, reason."""
    todo, gaps, final, fixed = (F.col(c) for c in ("todo", "open_gaps", "terminal_gaps", "fixed"))
    reason = F.when(todo > 0, "todo-pending").when(gaps == 0, "no-todo-no-open-gaps").when(fixed > 0, "repair-progress").when(final == gaps, "repair-budget-exhausted").otherwise("repair-budget-left")
    x = runs.withColumn("reason", reason)
    return x.select("*", F.when(F.col("reason") == "no-todo-no-open-gaps", "done").otherwise("continue").alias("decided"), F.col("reason").isin("no-todo-no-open-gaps", "repair-budget-exhausted").alias("terminal"), F.when(F.col("reason") == "no-todo-no-open-gaps", 0).when(F.col("reason") == "repair-budget-exhausted", 3).alias("exit_code"))
