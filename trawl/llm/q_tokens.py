"""Query op4; tokenizers aren't SQL, so it is tested by round trips."""

import public_tokenizers

from trawl.llm import tokens
from trawl.llm.common import table


def op4_wavelet_tokens(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.read_documents(tokens.write_shards(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1))


QUERIES, SQL = {"op4_wavelet_tokens": op4_wavelet_tokens}, {}
