"""Facts in log lines (TXT-22)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.streaming.shared import written

# The patterns of a run's log, by name.
LOG_PATTERNS = {
    "branch": r"细分 '([^']*)' \(total=(\d+)\) -> (\d+)子块 覆盖(\d+) 缺口(\d+)",
    "leaf": r"叶子 '([^']*)' total=(\d+) 唯一=(\d+)",
    "pre_fetch": r"先抓 '([^']*)': (\d+) 条落盘",
    "probe_retry": r"探测失败 (\d+) 字符，30s 后重试（轮 (\d+)）",
    "probe_skip": r"探测失败 '([^']*)'，跳过",
    "big_gap": r"缺口 (\d+)（大），冷却",
    "final_repair_round": r"=== 终局修复轮：(\d+) 个遗留缺口 ===",
    "throttle_snapshot": r"\[throttle\] mode=(\w+) interval=([\d.]+)s",
    "throttle_adjust": r"\[throttle\] (.+?) \| interval=([\d.]+)->([\d.]+)s",
    "http_retry": r"HTTP (\d{3}) q=",
    "exc": r"EXC (\w+):",
    "progress_fallback": r"progress.json 不可用（缺失/空/损坏）→ 回退 progress.json.bak",
    "records_repair": r"records 修复（最小丢弃）：损坏行 (\d+) 行",
    "records_rebuild": r"records 全量反查重建：(\d+) 行有效记录",
    "reconcile": r"一致性自愈：扫描 (\d+) 行有效记录",
    "tolerance": r"容差|tolerance",
    "complete": r"全部完成",
    "converged": r"收敛：无新任务且无修复进展",
    "conc_item_error": r"\[conc\] 条目异常 '([^']*)': (\w+)",
}


def groups(pattern: str) -> range:
    """The groups a fact consists of: all of the pattern's, or the whole match if it has none."""
    n = re.compile(pattern).groups
    return range(1, n + 1) if n else range(1)


def log_facts(lines: DataFrame, line: str, order: list[str], patterns: dict[str, str] = LOG_PATTERNS, samples: int = 3) -> DataFrame:
    """name, n (matches), numeric (matches with a part of digits and points only), samples (the first ones in this order, parts joined by |).

    Patterns without a match have no row. Lines are read once: their matches, a small part of them, are written, and then counted and sampled; the first few of each name are taken before the shuffle."""

    def facts(name, p):
        parts = F.arrays_zip(*[F.regexp_extract_all(line, F.lit(p), F.lit(i)).alias(f"g{i}") for i in groups(p)])
        return F.transform(parts, lambda m, i: F.struct(F.lit(name).alias("name"), i.alias("at"), F.array(*[m[f"g{j}"] for j in groups(p)]).alias("parts")))

    hits = lines.select(*order, F.explode(F.concat(*[facts(k, p) for k, p in patterns.items()])).alias("h")).select(*order, "h.*")
    hits = written(hits, "matches")
    n = hits.groupBy("name").agg(F.count("*").alias("n"), F.sum(F.exists("parts", lambda x: x.rlike(r"^[0-9.]+$")).cast("long")).alias("numeric"))
    first = hits.withColumn("no", F.row_number().over(Window.partitionBy("name").orderBy(*order, "at"))).where(F.col("no") <= samples)
    first = first.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("no", F.array_join("parts", "|").alias("text")))).alias("s"))
    return n.join(first, "name").select("name", "n", "numeric", F.col("s.text").alias("samples"))
