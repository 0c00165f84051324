"""The queries of this subpackage and their SQL."""

from trawl.llm import q_automaton, q_jaccard, q_language, q_leaks, q_merkle, q_packing, q_pii, q_ranking, q_secrets, q_tokens, q_topk, q_toxicity, q_urls

MODULES = (q_jaccard, q_language, q_leaks, q_packing, q_pii, q_ranking, q_secrets, q_tokens, q_topk, q_toxicity, q_urls, q_automaton, q_ranking, q_merkle)


def queries():
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql():
    return {k: s for m in MODULES for k, s in m.SQL.items()}
