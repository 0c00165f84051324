"""Query op9; alignment isn't SQL, so it is tested against a full edit-distance table."""

from trawl.llm import leaks
from trawl.llm.common import table


def op9_benchmark_leaks(spark, sf_dir):
    return leaks.find(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


QUERIES, SQL = {"op9_benchmark_leaks": op9_benchmark_leaks}, {}
