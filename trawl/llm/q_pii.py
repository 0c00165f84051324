"""Query op3; the tagger isn't SQL. The patterns' part is tested against Python's re, the tagger by spans written in ways the patterns miss."""

from pyspark.sql import functions as F

from trawl.llm import pii
from trawl.llm.common import table


def op3_pii_bilstm_crf(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pii.scan(docs, pii.fit(docs))
    said = lambda c: f"concat_ws(',', transform({c}, x -> concat(x.kind, ':', x.s, ':', x.e)))"
    counts = [f"cast(size(filter(base, x -> x.kind = '{k}')) AS bigint) AS n_{k}" for k in pii.KINDS]
    return out.select("doc_id", *map(F.expr, counts), F.sha2(F.expr(said("base")), 256).alias("base_sha256"), F.expr(said("spans")).alias("spans"))


QUERIES, SQL = {"op3_pii_bilstm_crf": op3_pii_bilstm_crf}, {}
