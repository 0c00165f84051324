"""Query op8; the choice of boundaries isn't SQL, so it is tested against all possible boundaries."""

import public_tokenizers

from trawl.llm import packing, tokens
from trawl.llm.common import table


def op8_length_buckets(spark, sf_dir):
    docs = tokens.lengths(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(docs, buckets=16, budget=65_536, length=docs["n_tokens"])


QUERIES, SQL = {"op8_length_buckets": op8_length_buckets}, {}
