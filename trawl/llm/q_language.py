"""Query op1; learned filters aren't SQL, so it is tested by held-out accuracy and against exact sets of n-grams."""

from pyspark.sql import functions as F

from trawl.llm import language
from trawl.llm.common import fold, table


def held_out():
    return F.coalesce(fold("doc_id", 3) == 1, F.lit(False))


def op1_language_bitmask(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    filters = language.fit(docs.where(~held_out()).select("doc_id", "text", "lang"))
    return language.predict(docs, filters).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "known")


QUERIES, SQL = {"op1_language_bitmask": op1_language_bitmask}, {}
