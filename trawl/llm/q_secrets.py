"""Query op7: no SQL, as the method's own spans need it all; the base spans are tested against Python's re."""

from trawl.llm import secrets
from trawl.llm.common import table


def op7_secret_scan(spark, sf_dir):
    out = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [f"cast(size(filter(base, x -> x.k = {i})) AS bigint) AS n_{k}" for i, k in enumerate(secrets.KINDS[:3])]
    return out.selectExpr("doc_id", *counts, f"sha2({secrets.written('base')}, 256) AS base_sha256", f"{secrets.written('spans')} AS spans")


QUERIES, SQL = {"op7_secret_scan": op7_secret_scan}, {}
