"""Query op2 and its SQL."""

from trawl.llm import jaccard
from trawl.llm.common import table


def op2_jaccard_trees(spark, sf_dir):
    return jaccard.join(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


QUERIES = {"op2_jaccard_trees": op2_jaccard_trees}
LINKED = r"""w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
sh AS (SELECT DISTINCT doc_id, CASE WHEN len(words) < 4 THEN array_to_string(words, ' ') ELSE array_to_string(words[i : i + 3], ' ') END AS s
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 3))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS inter FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * inter >= 85 * (na.n + nb.n - inter)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)"""
SQL = {"op2_jaccard_trees": f"WITH RECURSIVE {LINKED} SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, comp.component_id FROM w LEFT JOIN n USING (doc_id) JOIN comp USING (doc_id)"}
