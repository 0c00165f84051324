"""Snapshot versions, change ledger and report per site, over documents taken as captures in doc_id order."""

from pyspark.sql import functions as F

from trawl.operators import snapshots


def w2_site_report(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    captures = docs.select(F.col("source").alias("site_id"), F.col("doc_id").alias("ord"), F.sha2("text", 256).alias("sha"))
    v = snapshots.versions(captures)
    return snapshots.report(v)


QUERIES = {"w2_site_report": w2_site_report}
SQL = {
    "w2_site_report": """
WITH c AS (SELECT source AS site_id, doc_id AS ord, sha256(text) AS sha FROM documents),
l AS (SELECT *, lag(sha) OVER (PARTITION BY site_id ORDER BY ord) AS prev, row_number() OVER (PARTITION BY site_id ORDER BY ord) AS rn FROM c),
n AS (SELECT *, CASE WHEN rn = 1 OR sha IS DISTINCT FROM prev THEN 1 ELSE 0 END AS is_new FROM l),
v AS (SELECT *, row_number() OVER (PARTITION BY site_id, sha ORDER BY ord) AS seen FROM n WHERE is_new = 1)
SELECT c.site_id, count(*) AS captures, max(vv.versions) AS versions, max(vv.changes) AS changes, max(vv.flaps) AS flaps, max(vv.last_sha12) AS last_sha12
FROM c JOIN (SELECT site_id, count(*) AS versions, count(*) - 1 AS changes, sum(CASE WHEN seen > 1 THEN 1 ELSE 0 END) AS flaps, substr(arg_max(sha, ord), 1, 12) AS last_sha12 FROM v GROUP BY site_id) vv USING (site_id)
GROUP BY c.site_id
"""
}
