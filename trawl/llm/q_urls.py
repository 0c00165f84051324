"""Query op10 and its SQL."""

from pyspark.sql import functions as F

from trawl.llm import urls
from trawl.llm.common import table


def op10_url_reputation(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return urls.judge(pages).select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict")


_LAST = r"(:[0-9]*)?$"
_TWO = rf"regexp_extract(host, '([^.:]+\.[^.:]+){_LAST}', 1)"
_PUBLIC, _THREE = f"regexp_extract(host, '{urls._DOUBLE}', 1)", f"regexp_extract(host, '{urls._DOUBLE_DOMAIN}', 1)"
_TEXT = "length(regexp_replace(html, '<[^>]*>', '', 'g'))"
_BAD = f"""(length(html) - length(translate(html, '{urls.SYMBOLS}', ''))) * {urls.NOISE} > length(html) OR regexp_matches(translate(path, '{urls.UPPER}', '{urls.LOWER}'), '{urls._WORD}')
  OR {_TEXT} < {urls.THIN} OR (length(html) - length(replace(html, '<a ', ''))) / 3.0 * {urls.CROWDED} > {_TEXT}"""
_FITS = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for v, h, p in sorted(urls.RULES, key=lambda r: -len(r[1] + r[2]))]


def _strength(level):
    return f"""(SELECT CASE WHEN coalesce(sum(n), 0) = 0 THEN {urls.WEAKEST} WHEN var_pop(bad / n) - avg(bad / n) * (1 - avg(bad / n)) * avg(1.0 / n) <= 0 THEN {urls.STRONGEST}
      ELSE least({urls.STRONGEST}, greatest({urls.WEAKEST}, avg(bad / n) * (1 - avg(bad / n)) / (var_pop(bad / n) - avg(bad / n) * (1 - avg(bad / n)) * avg(1.0 / n)) - 1)) END FROM {level} WHERE n > 0)"""


SQL = {
    "op10_url_reputation": rf"""
WITH p AS (SELECT page_id, html, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{urls.UPPER}', '{urls.LOWER}') AS host, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
hosts0 AS (SELECT host, count(html) AS n, coalesce(sum(CASE WHEN html IS NOT NULL AND ({_BAD}) THEN 1 ELSE 0 END), 0)::DOUBLE AS bad FROM p GROUP BY host),
hosts AS (SELECT *, CASE WHEN {_PUBLIC} <> '' THEN {_PUBLIC} ELSE regexp_extract(host, '([^.:]+){_LAST}', 1) END AS suffix,
  CASE WHEN regexp_matches(host, '^[0-9.]+(:[0-9]*)?$') OR (CASE WHEN {_PUBLIC} <> '' THEN {_THREE} ELSE {_TWO} END) = '' THEN host ELSE CASE WHEN {_PUBLIC} <> '' THEN {_THREE} ELSE {_TWO} END END AS domain FROM hosts0),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix),
s AS (SELECT {_strength('suffixes')} AS s0, {_strength('domains')} AS s1, {_strength('hosts')} AS s2, (SELECT CASE WHEN coalesce(sum(n), 0) = 0 THEN 0.5 ELSE (sum(bad) + 0.5) / (sum(n) + 1.0) END FROM suffixes) AS base),
top AS (SELECT suffix, (bad + s0 * base) / (n + s0) AS r FROM suffixes, s),
mid AS (SELECT d.domain, d.suffix, (d.bad + s1 * t.r) / (d.n + s1) AS r FROM domains d JOIN top t USING (suffix), s),
ab AS (SELECT host, h.bad + s2 * m.r AS a, h.n - h.bad + s2 * (1 - m.r) AS b FROM hosts h JOIN mid m USING (domain, suffix), s)
SELECT page_id, host, path, CASE {' '.join(f"WHEN {f} THEN '{r}'" for f, r, _ in _FITS)} END AS rule,
  CASE {' '.join(f"WHEN {f} THEN '{v}'" for f, _, v in _FITS)} WHEN a / (a + b) - {urls.Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > least({urls.HIGHEST}, {urls.LIFT} * base) THEN 'block' ELSE 'allow' END AS verdict
FROM p JOIN ab USING (host), s
"""
}
QUERIES = {"op10_url_reputation": op10_url_reputation}
