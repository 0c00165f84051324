"""Watermarks, stalls, flapping, breaker and limiter replays."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.operators.order import AT, PART, dealt, scan

# Breaker and limiter constants.
THRESHOLD, COOLDOWN, BLOCK_COOLDOWN = 5, 120.0, 180.0
BASE, CEILING, FLOOR = 2.5, 60.0, 0.2
COUNTED = ("transient", "limited", "blocked")


def watermarks(df: DataFrame, key: str, order: list[str], leaves: str, records: str, t: str) -> DataFrame:
    """Monotone high-water marks: wm_leaves, wm_records, advanced, clamped, advance_count, clamp_events, clamp_episode, first_clamp_t, wm_t.

    As the other functions on runs here, by prefix scans over range partitions: no run is one task's work."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    x = dealt(df, [key], [F.col(o) for o in order])
    x = scan(x, [key], maxima={"_wl": F.col(leaves), "_wr": F.col(records)}, sums={"_row": F.lit(1)})
    x = scan(x, [key], lags={"_pl": F.col("_wl"), "_pr": F.col("_wr")})
    x = x.withColumn("_pl", zero("_pl")).withColumn("_pr", zero("_pr"))
    x = x.withColumn("wm_leaves", F.greatest("_pl", leaves)).withColumn("wm_records", F.greatest("_pr", records))
    x = x.withColumn("advanced", (F.col("wm_leaves") > F.col("_pl")) | (F.col("wm_records") > F.col("_pr"))).withColumn("clamped", (F.col(leaves) < F.col("_pl")) | (F.col(records) < F.col("_pr")))
    advance = F.when(F.col("advanced") | (F.col("_row") == 1), F.col(t))
    x = scan(x, [key], sums={"advance_count": F.col("advanced").cast("int"), "clamp_events": F.col("clamped").cast("int")}, maxima={"wm_t": advance}, lags={"_pc": F.col("clamped")})
    # an episode is counted from the last row that wasn't clamped, and begins where none was before
    begins = F.col("clamped") & ~F.coalesce(F.col("_pc"), F.lit(False))
    x = scan(x, [key], lasts={"_before": F.when(~F.col("clamped"), F.col("clamp_events")), "first_clamp_t": F.when(begins, F.col(t))})
    x = x.withColumn("clamp_episode", F.col("clamp_events") - zero("_before")).withColumn("first_clamp_t", F.when(F.col("clamped"), F.col("first_clamp_t")))
    return x.drop("_wl", "_wr", "_row", "_pl", "_pr", "_pc", "_before", PART, AT)


def stalls(df: DataFrame, key: str, order: list[str], mark: str, t: str, limit: int = 900) -> DataFrame:
    """Rows where a stall is first seen: age since the mark's last change is limit or more, once until the mark changes again."""
    x = dealt(df, [key], [F.col(o) for o in order])
    x = scan(x, [key], lags={"_prev": F.col(mark)}, sums={"_row": F.lit(1)})
    x = x.withColumn("_ch", (F.col("_row") == 1) | ~F.col(mark).eqNullSafe(F.col("_prev")))
    x = scan(x, [key], lasts={"_since": F.when(F.col("_ch"), F.struct(F.col(t).alias("t")))}).withColumn("age", F.col(t) - F.col("_since.t"))
    x = x.withColumn("_late", F.coalesce(F.col("age") >= limit, F.lit(False)).cast("int"))
    x = scan(x, [key], sums={"_n": F.col("_late")})
    x = scan(x, [key], lasts={"_base": F.when(F.col("_ch"), F.col("_n") - F.col("_late"))})
    return x.where((F.col("_late") == 1) & (F.col("_n") - F.col("_base") == 1)).drop("_prev", "_row", "_ch", "_since", "_late", "_n", "_base", PART, AT)


def since(x: DataFrame, key: str, counted: Column, name: str) -> DataFrame:
    """Dealt rows with the number of counted rows in a row up to each; a row that isn't counted sets it to 0."""
    x = scan(x.withColumn("_is", F.coalesce(counted, F.lit(False))), [key], sums={"_n": F.col("_is").cast("int")})
    x = scan(x, [key], lasts={"_base": F.when(~F.col("_is"), F.col("_n"))})
    return x.withColumn(name, F.col("_n") - F.coalesce("_base", F.lit(0))).drop("_is", "_n", "_base")


def no_progress(df: DataFrame, key: str, order: list[str], progressed: str, limit: int = 5) -> DataFrame:
    """Rows at which a run of iterations without progress reaches the limit."""
    x = since(dealt(df, [key], [F.col(o) for o in order]), key, ~F.col(progressed), "streak")
    return x.where((F.col("streak") == limit) & ~F.col(progressed)).drop(PART, AT)


def flapping(deaths: DataFrame, key: str, order: list[str], lifetime: str, rapid: int = 20, limit: int = 3, tick: int = 5, cap: int = 120) -> DataFrame:
    """deaths with rapid_n (consecutive short lives), flapping, wait."""
    x = since(dealt(deaths, [key], [F.col(o) for o in order]), key, F.col(lifetime) < rapid, "rapid_n")
    wait = F.least(F.lit(cap), tick * F.pow(F.lit(2), F.greatest(F.col("rapid_n") - 1, F.lit(0)))).cast("int")
    return x.withColumn("flapping", F.col("rapid_n") >= limit).withColumn("wait", wait).drop(PART, AT)


def heartbeat_verdict(h: DataFrame, stale: int = 900, grace: int = 120, gate_warn: int = 30, gate_freeze: int = 300) -> DataFrame:
    """h: run, state, age, since_boot, pid_alive, gate_closed_s, backoff, clamped_s -> verdict and reasons in order."""
    freezes = F.col("gate_closed_s") >= gate_freeze
    old = (F.col("age") >= stale) & (F.col("since_boot") >= grace) & ~freezes
    reasons = F.array_compact(F.array(
        F.when(~F.col("pid_alive"), "process_dead"), F.when(old & ~F.col("backoff"), "no_progress"), F.when(old & F.col("backoff"), "backoff"),
        F.when(freezes, "gate_frozen"), F.when(F.col("gate_closed_s").between(gate_warn, gate_freeze - 1), "gate_closed"), F.when(F.col("clamped_s") > 0, "clamped"),
    ))
    verdict = F.when(F.col("state") == "done", "DONE").when(~F.col("pid_alive") | (old & ~F.col("backoff")), "STALL").when(F.size(reasons) > 0, "WARN").otherwise("OK")
    return h.select("*", verdict.alias("verdict"), F.when(F.col("state") == "done", F.array().cast("array<string>")).otherwise(reasons).alias("reasons"))


class Breaker:
    """One domain's breaker; state can be taken out and put back, so batch and stream share it."""

    def __init__(self, state: tuple = ("closed", 0, 0.0)):
        self.state, self.streak, self.until = state

    def step(self, t: float, cls: str) -> list[tuple[str, str]]:
        """Transitions that a request at t with this outcome makes."""
        moves = []
        if self.state == "open":
            if t < self.until:
                return moves
            moves.append(("open", "half_open"))
            self.state = "half_open"
        if cls == "ok":
            self.streak = 0
            if self.state != "closed":
                moves.append((self.state, "closed"))
                self.state = "closed"
        elif cls in COUNTED:
            self.streak += 1
            if self.state == "half_open" or (self.state == "closed" and self.streak >= THRESHOLD):
                moves.append((self.state, "open"))
                self.state, self.until = "open", t + (BLOCK_COOLDOWN if cls == "blocked" else COOLDOWN)
        return moves


def breaker(df: DataFrame) -> DataFrame:
    """df: domain, ord, t, cls -> domain, ord, state_from, state_to; real transitions only. One domain's rows are replayed in one task."""

    def replay(pdf: pd.DataFrame) -> pd.DataFrame:
        b, out = Breaker(), []
        for r in pdf.sort_values(["t", "ord"]).itertuples():
            out += [(r.domain, r.ord, a, z) for a, z in b.step(r.t, r.cls)]
        return pd.DataFrame(out, columns=["domain", "ord", "state_from", "state_to"]).astype({"domain": "int64", "ord": "int64"})

    return df.groupBy("domain").applyInPandas(replay, "domain long, ord long, state_from string, state_to string")


def limiter(df: DataFrame) -> DataFrame:
    """df: domain, ord, t, cls -> domain, ord, interval_from, interval_to; changes only."""

    def replay(pdf: pd.DataFrame) -> pd.DataFrame:
        cur, out = max(BASE, FLOOR), []
        for r in pdf.sort_values(["t", "ord"]).itertuples():
            new = cur
            if r.cls in ("limited", "blocked"):
                new = min(CEILING, max(cur * 2, BASE * 2))
            elif r.cls == "ok" and cur > BASE:
                new = max(BASE, cur * 0.9)
            if new != cur:
                out.append((r.domain, r.ord, round(cur, 3), round(new, 3)))
            cur = new
        return pd.DataFrame(out, columns=["domain", "ord", "interval_from", "interval_to"]).astype({"domain": "int64", "ord": "int64", "interval_from": "float64", "interval_to": "float64"})

    return df.groupBy("domain").applyInPandas(replay, "domain long, ord long, interval_from double, interval_to double")
