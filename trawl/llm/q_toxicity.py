"""Query op6; a learned score isn't SQL, so it is tested by held-out accuracy and against all cosines."""

from pyspark.sql import functions as F

from trawl.llm import toxicity
from trawl.llm.common import fold, table


def op6_toxicity_neighbours(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold("doc_id", 5) != 0)
    out = toxicity.score(docs, toxicity.fit(docs, labels))
    return out.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "neighbours")


QUERIES, SQL = {"op6_toxicity_neighbours": op6_toxicity_neighbours}, {}
