"""The driver's tables seen as crawl data; each view has the same mapping in SQL."""

from pyspark.sql import functions as F


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


STATUS = (200, 200, 200, 204, 301, 400, 401, 403, 404, 408, 410, 429, 451, 500, 503, 599, 100, None)
NAMES = ("ReadTimeout", "ConnectionError", "ValueError", "SSLError", "KeyError", "gaierror", "OSError")
MESSAGES = ("Read timed out", "connection reset by peer", "bad value", "certificate verify failed", "Connect timeout after", "getaddrinfo failed", "")
_pick = lambda values, n: F.element_at(F.array(*[F.lit(v).cast("int") if isinstance(v, int) or v is None else F.lit(v) for v in values]), (n % len(values) + 1).cast("int"))


def requests(spark, sf_dir):
    """events as requests: domain = user_id, t = seconds, status, exception name and message, attempt, limit."""
    e = read(spark, sf_dir, "events")
    n = F.col("event_id")
    return e.select(
        "event_id", F.col("user_id").alias("domain"), "ts", F.unix_timestamp("ts").alias("t"), "event_type", "value", _pick(STATUS, n * 7).alias("status"), _pick(NAMES, n).alias("exc"), _pick(MESSAGES, n * 3).alias("msg"),
        (n % 4).alias("attempt"), F.when(n % 3 == 0, 500).when(n % 3 == 1, 1).otherwise(50).alias("lim"),
    )


_list = lambda values: "[" + ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"
REQUESTS = f"""req AS (SELECT event_id, user_id AS domain, ts, floor(epoch(ts))::BIGINT AS t, event_type, value, ({_list(STATUS)})[event_id * 7 % {len(STATUS)} + 1] AS status, ({_list(NAMES)})[event_id % {len(NAMES)} + 1] AS exc,
  ({_list(MESSAGES)})[event_id * 3 % {len(MESSAGES)} + 1] AS msg, event_id % 4 AS attempt, CASE event_id % 3 WHEN 0 THEN 500 WHEN 1 THEN 1 ELSE 50 END AS lim FROM events)"""
