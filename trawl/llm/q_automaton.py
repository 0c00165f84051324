"""Query op11; tokenizers aren't SQL, so it is tested against the library."""

import public_tokenizers
from pyspark.sql import functions as F

from trawl.llm import automaton
from trawl.llm.common import table


def op11_merge_automaton(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    both = automaton.decoded(automaton.encoded(table(spark, sf_dir, "documents"), path), path)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


QUERIES, SQL = {"op11_merge_automaton": op11_merge_automaton}, {}
