"""Query op13 and its SQL."""

from pyspark.sql import functions as F

from trawl.llm import merkle
from trawl.llm.common import fold, table


def op13_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    lower = F.translate("text", merkle.UPPER, merkle.LOWER)
    return merkle.manifest(docs, tampered={"text": lower}, when=fold("doc_id", 3) == 0)


#: Levels that the SQL spells out: 8 ** 12 rows of a group.
_LEVELS = 12


def _leaf(text):
    def part(c, n):
        return f"coalesce({n}::VARCHAR || ':' || {c}::VARCHAR, '-')"

    return "sha256(" + " || ".join([part("doc_id", "length(doc_id::VARCHAR)"), part("source", "strlen(source)"), part("lang", "strlen(lang)"), part("n_chars", "length(n_chars::VARCHAR)"), part(text, f"strlen({text})")]) + ")"


#: crc32 of a text of digits, a bit at a time.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: [ord(substr(doc_id::VARCHAR, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)"""


def _tree(name, source, levels):
    """Tables name0, name1 ...: (g, i, d) and beside each its runs: siblings before and after, and whether a level follows."""
    out = [f"{name}0 AS ({source})"]
    for k in range(levels):
        out.append(f"""{name}s{k} AS (SELECT g, i, d, n, CASE WHEN n > 1 THEN coalesce(string_agg(d, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS b,
          CASE WHEN n > 1 THEN coalesce(string_agg(d, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS a FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {name}{k}) WINDOW w AS (PARTITION BY g, i // 8 ORDER BY i))""")
        out.append(f"{name}{k + 1} AS (SELECT g, i // 8 AS i, CASE WHEN max(n) > 1 THEN sha256(string_agg(d, '' ORDER BY i)) ELSE min(d) END AS d FROM {name}s{k} GROUP BY 1, 2)")
    return ", ".join(out)


def _climb(level, name, k, group, at):
    """One level of every row's proof and fold."""
    return f"""SELECT x.* EXCLUDE (proof, f), x.proof || coalesce(s.b || s.a, '') AS proof, CASE WHEN s.b IS NULL THEN x.f ELSE sha256(s.b || x.f || s.a) END AS f
      FROM {level} x JOIN {name}s{k} s ON s.g = x.{group} AND s.i = x.{at} // {8**k}"""


_CLIMBS = [f"c{k + 1} AS ({_climb(f'c{k}', 't', k, 'g', 'i')})" for k in range(_LEVELS)]
_CLIMBS += [f"e0 AS (SELECT c.*, '' AS one, r.i AS j FROM c{_LEVELS} c JOIN r0 r ON r.name = c.g)"]
_CLIMBS += [f"e{k + 1} AS ({_climb(f'e{k}', 'r', k, 'one', 'j')})" for k in range(_LEVELS)]
SQL = {
    "op13_merkle_manifest": f"""WITH d AS (SELECT doc_id, coalesce('=' || lang, '-') AS g, {_leaf('text')} AS leaf, CASE WHEN {_CRC} % 3 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS other FROM documents),
      l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
      {_tree('t', 'SELECT g, i, leaf AS d FROM l', _LEVELS)},
      {_tree('r', f"SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, d, g AS name FROM t{_LEVELS}", _LEVELS)},
      c0 AS (SELECT doc_id, g, i, leaf, coalesce(other, leaf) AS f, '' AS proof FROM l), {', '.join(_CLIMBS)}
      SELECT e.doc_id, e.leaf, s.d AS subroot, root.d AS root, sha256(e.proof) AS proof_sha256, e.f AS folded_root, e.f = root.d AS verified
      FROM e{_LEVELS} e JOIN t{_LEVELS} s ON s.g = e.g, r{_LEVELS} root"""
}
QUERIES = {"op13_merkle_manifest": op13_merkle_manifest}
