"""Query op12 and its SQL."""

from trawl.llm import ranking
from trawl.llm.common import table


def op12_presence_masks(spark, sf_dir):
    return ranking.search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


_CUT = r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"
SQL = {
    "op12_presence_masks": f"""WITH w AS (SELECT doc_id, {_CUT} FROM documents), b AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, {_CUT} FROM benchmark) GROUP BY 1, 2),
      p AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY 1, 2), d AS (SELECT doc_id, count(*) AS n FROM w GROUP BY 1), t AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM d),
      v AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, t WHERE term IN (SELECT term FROM b) GROUP BY term, docs),
      s AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score FROM b JOIN v USING (term) JOIN p USING (term) JOIN d USING (doc_id), t GROUP BY 1, 2)
      SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s WHERE score > 0 QUALIFY rank <= 10"""
}
QUERIES = {"op12_presence_masks": op12_presence_masks}
