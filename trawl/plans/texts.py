"""Text queries: TXT."""

from pyspark.sql import functions as F

from trawl.functions import results as R
from trawl.functions import text as T
from trawl.operators.logs import LOG_PATTERNS, groups, log_facts
from trawl.plans.classes import LEADS, _leads
from trawl.plans.tables import REQUESTS, read, requests

_SCRIPTS = r"regexp_replace(regexp_replace({}, '(?is)<script.*?</script>', ' ', 'g'), '(?is)<style.*?</style>', ' ', 'g')"
_TAGS = r"regexp_replace(regexp_replace(regexp_replace({}, '(?i)<br\s*/?>', chr(10), 'g'), '(?i)</(p|div|li|tr|h[1-6]|section|article|td|th)>', chr(10), 'g'), '<[^>]+>', ' ', 'g')"


def _entities(c, pairs=T.ENTITIES):
    for a, b in pairs:
        c = f"replace({c}, '{a}', {'chr(39)' if b == chr(39) else repr(b)})"
    return c


_TEXT = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, '[ \t\r\f\v]+', ' ', 'g'), ' *\n *', chr(10), 'g'), '\n{{2,}}', chr(10), 'g'), '^\s+|\s+$', '', 'g')".format(_entities(_TAGS.format(_SCRIPTS.format("coalesce(html, '')"))))
_PLAIN = _entities(r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script\s*>', ' ', 'g'), '(?is)<style[^>]*>.*?</style\s*>', ' ', 'g'), '(?is)<noscript[^>]*>.*?</noscript\s*>', ' ', 'g'), '<[^>]+>', ' ', 'g')", (*[(a, "\u00a0" if a == "&nbsp;" else b) for a, b in (*T.ENTITIES[1:], ("&copy;", "©"), ("&middot;", "·"))], T.ENTITIES[0]))
#: References and what they stand for.
REFERENCES = (("&eacute;", "é"), ("&#233;", "é"), ("&#xE9;", "é"), ("&copy ", "© "), ("&amp;lt;", "&lt;"), ("&notin;", "∉"), ("&nosuch;", "&nosuch;"), ("&frac12;", "½"), ("&#128512;", "😀"), ("&#x1F600;", "😀"), ("&euro;", "€"), ("&#0;", "�"), ("&ngE;", "≧̸"), ("&hellip;", "…"))
_TITLE = r"substr(trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')), 1, 200)"
WORDS = ("the", "Que", "UND", "zzz")


def txt_01_html_text(spark, d):
    return read(spark, d, "pages").select("page_id", T.html_text(F.col("html")).alias("text"))


def txt_02_html_plain(spark, d):
    """Pages with a line of references behind their text, as many as the page's length picks: named, decimal, hexadecimal, without semicolon, doubly escaped."""
    html = F.concat(F.array_join(F.slice(F.array(*[F.lit(a) for a, _ in REFERENCES]), 1, (F.length("html") % (len(REFERENCES) + 1)).cast("int")), "|"), F.lit("\n"), "html")
    return read(spark, d, "pages").select("page_id", F.md5(T.html_plain(html)).alias("md5"))


def txt_03_title(spark, d):
    return read(spark, d, "pages").select("page_id", T.page_title(F.col("html")).alias("title"))


def txt_04_links(spark, d):
    return read(spark, d, "pages").select("page_id", F.explode(T.links(F.col("html"), F.col("url"))).alias("link"))


LINKS_SQL = r"""raw AS (SELECT page_id, url, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS x FROM pages),
  li AS (SELECT page_id, CASE WHEN regexp_matches(x, '^https?://') THEN x WHEN starts_with(x, '//') THEN regexp_extract(url, '^(https?:)', 1) || x WHEN starts_with(x, '/') THEN regexp_extract(url, '^(https?://[^/?#]+)', 1) || x
    WHEN NOT regexp_matches(x, '^[a-zA-Z][a-zA-Z0-9+.-]*:') AND NOT starts_with(x, '#') THEN rtrim(regexp_extract(url, '^(https?://[^/?#]+(?:/[^?#]*/|/)?)', 1), '/') || '/' || x END AS link FROM raw)"""


def txt_05_images(spark, d):
    p = read(spark, d, "pages").select("page_id", F.concat(F.lit('<img a="1" src="/i?a=1&amp;b=2"><img src="/x.png"><img src="/x.png">'), F.col("html")).alias("html"))
    return p.select("page_id", F.posexplode(T.images(F.col("html"))).alias("pos", "image"))


def txt_06_squeeze(spark, d):
    return read(spark, d, "documents").select("doc_id", F.md5(T.squeezed(F.regexp_replace("text", "<[^>]+>", " "))).alias("md5"))


#: The forms by number, and how a result stands in each: {h} and {t} for link and title, AED for what may follow.
FORM_NAMES = ("so360", "sogou", "bing", "brave", "weixin")
_SHAPES = ('<h3 class="res-title x"><a href="{h}">{t}</a></h3>', '<h3> <a id="i" href="{h}">{t}</a></h3>', '<h2 class="t"><a href="{h}">{t}</a></h2>', '<a rel="r" href="{h}">{t}</a>', '<h3><a href="{h}">{t}</a></h3>AED')
_ANCHOR = r'<a [^>]*href="([^"]*)"[^>]*>([^<]*)</a>'


def txt_07_search_rows(spark, d):
    """Result pages of five forms, made of each page's own links: some scripts, some redirects, with and without account, time and digest."""
    n = F.length("html") % len(FORM_NAMES)
    p = read(spark, d, "pages").select("page_id", n.cast("int").alias("n"), F.arrays_zip(F.regexp_extract_all("html", F.lit(_ANCHOR), F.lit(1)).alias("h"), F.regexp_extract_all("html", F.lit(_ANCHOR), F.lit(2)).alias("t")).alias("a"))

    def shaped(x, i):
        href = F.when(i % 7 == 3, "javascript:;").when(i % 5 == 2, F.concat(F.lit("/link?url="), x["h"])).when(i % 2 == 0, F.concat(F.lit("http://x.org"), x["h"])).otherwise(x["h"])
        out = F.replace(F.replace(F.element_at(F.array(*map(F.lit, _SHAPES)), F.col("n") + 1), F.lit("{h}"), href), F.lit("{t}"), x["t"])
        more = F.concat(F.when(i % 2 == 0, F.concat(F.lit('<a class="account" href="#">by '), i.cast("string"), F.lit("</a>"))).otherwise(""), F.when(i % 3 == 0, F.concat(F.lit("document.write(timeConvert('17"), i.cast("string"), F.lit("'))"))).otherwise(""), F.when(i % 4 == 0, '<p class="txt-info">some <b>digest</b></p>').otherwise(""))
        return F.when(F.col("n") == 4, F.concat(F.substring(out, 1, F.length(out) - 3), more)).otherwise(out)

    p = p.select("page_id", "n", F.concat(F.array_join(F.transform("a", shaped), "\n"), F.lit("</ul>")).alias("html"))
    out = None
    for k, name in enumerate(FORM_NAMES):
        x = R.result_rows(p.where(F.col("n") == k), R.FORMS[name]).select("page_id", F.lit(name).alias("form"), F.posexplode("results").alias("at", "r")).select("page_id", "form", "at", "r.*")
        out = x if out is None else out.unionByName(x)
    return out


def txt_09_article(spark, d):
    p = read(spark, d, "pages")
    first = lambda pattern: F.nullif(F.regexp_extract("html", pattern, 1), F.lit(""))
    title = F.coalesce(first(r'og:title" content="([^"]*)"'), first(r"(?is)<h1[^>]*>(.*?)</h1>"), first(r"(?is)<title[^>]*>(.*?)</title>"), F.lit(""))
    at = F.locate("<article", "html")
    return p.select("page_id", F.substring(title, 1, 80).alias("title"), F.md5(F.when(at > 0, F.expr("substr(html, locate('<article', html), 400000)")).otherwise(F.substring("html", 1, 400_000))).alias("body_md5"))


def txt_11_relevance(spark, d):
    x = read(spark, d, "documents")
    return x.select("doc_id", T.relevance(F.col("text"), ("the th", "der "), ("and ", "que ", "und ", "heha", "tion"), "with").alias("rel"))


_REL = "least(100, CASE WHEN contains(t, 'the th') OR contains(t, 'der ') THEN 45 ELSE 0 END + least(40, 8 * (" + " + ".join(f"contains(t, '{k}')::INT" for k in ("and ", "que ", "und ", "heha", "tion")) + ")) + CASE WHEN contains(t, 'with') THEN 15 ELSE 0 END)"


def txt_12_confidence(spark, d):
    x = _leads(spark, d).withColumn("rel", T.relevance(F.col("text"), ("the th", "der "), ("and ", "que ", "und ", "heha", "tion"), "with"))
    return x.select("doc_id", T.confidence(F.col("kind"), F.col("evidence").contains("of"), F.col("rel")).alias("conf"))


def txt_13_watch_words(spark, d):
    return read(spark, d, "documents").select("doc_id", F.explode(T.watch_counts(F.col("text"), WORDS)).alias("w")).select("doc_id", "w.word", "w.n")


def txt_14_fingerprints(spark, d):
    x = read(spark, d, "documents")
    return x.select("doc_id", F.sha2("text", 256).alias("sha256"), F.sha1("text").alias("sha1"), F.substring(F.sha2("text", 256), 1, 12).alias("sha12"))


TIMES = ("1735689600", "1735689600.25", "2025-01-01T00:00:00Z", "2025-01-01T08:00:00+08:00", "2025-01-01T00:00:00", "junk", "")


def txt_15_to_epoch(spark, d):
    e = read(spark, d, "events").select("event_id", F.element_at(F.array(*map(F.lit, TIMES)), (F.col("event_id") % len(TIMES) + 1).cast("int")).alias("v"))
    return e.groupBy("v", T.to_epoch(F.col("v"), "Asia/Shanghai").alias("epoch")).agg(F.count("*").alias("n"))


def txt_16_iso(spark, d):
    return read(spark, d, "events").select("event_id", T.iso_at(F.unix_timestamp("ts")).alias("iso"))


def txt_17_host(spark, d):
    return read(spark, d, "pages").select("page_id", T.host_of(F.col("url")).alias("host"))


def txt_18_hex_param(spark, d):
    p = read(spark, d, "pages").select("page_id", F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("?param="), F.lower(F.hex(F.concat(F.lit('{"uin":"'), F.col("page_id").cast("string"), F.lit('"}')))))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("var rawuin = "), F.col("page_id").cast("string"))).otherwise(F.lit("none")).alias("page"))
    return p.select("page_id", T.hex_param(F.col("page")).alias("id"))


def txt_19_verdict(spark, d):
    x = read(spark, d, "labels").select("doc_id", F.format_string('I say {"intl": %s, "category": "c%s"} so', F.when(F.col("toxic") == 1, "true").otherwise("false"), F.col("quality").cast("string")).alias("said"))
    return x.select("doc_id", T.json_in(F.col("said"), "intl boolean, category string").alias("v")).select("doc_id", "v.intl", "v.category")


def txt_20_header(spark, d):
    x = read(spark, d, "documents").select("doc_id", "text", F.concat(F.lit("# site: x\n# sha256: "), F.sha2("text", 256), F.lit("\n\n"), "text").alias("raw"))
    return x.select("doc_id", T.header_sha(F.col("raw")).alias("sha"), (T.header_stripped(F.col("raw")) == T.header_stripped(F.col("text"))).alias("same"))


def txt_21_tolerances(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", F.floor("o_totalprice").cast("long").alias("total"))
    return o.select("o_orderkey", T.leaf_tolerance(F.col("total")).cast("long").alias("leaf"), T.branch_threshold(F.col("total")).cast("long").alias("branch"))


FACTS = {"digits": r"([0-9]{3,})", "secret": r"(?:token|password) ?= ?\"?([0-9a-f]+)", "license": r"(Apache License)", "shout": r"([A-Z]{4,}!!)"}
PATTERNS = {**LOG_PATTERNS, **FACTS}


def txt_22_log_facts(spark, d):
    """Lines of documents and of requests, as a run logs them, against the run's patterns and four of the documents'."""
    x = read(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    r = requests(spark, d)
    line = F.when(F.col("status").isNull(), F.concat(F.lit("EXC "), "exc", F.lit(": "), "msg")).when(F.col("status") >= 400, F.concat(F.lit("HTTP "), "status", F.lit(" q="), "domain")).when(F.col("event_type") == "view", F.concat(F.lit("叶子 '"), "domain", F.lit("' total="), "lim", F.lit(" 唯一="), "attempt"))
    line = F.coalesce(line, F.concat(F.lit("[throttle] mode="), "event_type", F.lit(" interval="), "attempt", F.lit(".5s")))
    x = x.unionByName(r.select((-F.col("event_id")).alias("doc_id"), F.lit(0).alias("no"), line.alias("line")))
    return log_facts(x, "line", ["doc_id", "no"], PATTERNS).select("name", "n", "numeric", F.array_join("samples", ",").alias("samples"))


def txt_24_progress_problems(spark, d):
    """Problems of progress snapshots, one row each."""
    o = read(spark, d, "orders")
    n = F.col("o_orderkey")
    snap = F.when(n % 5 == 0, '{"todo": [{"q": 1}], "done": [], "stats": {"records": 3}}').when(n % 5 == 1, '{"todo": [], "stats": {"records": -1}}').when(n % 5 == 2, "not json").when(n % 5 == 3, '{"todo": [{"p": "A"}], "done": [{"p": "B"}], "stats": {"records": 1}}').otherwise('{"todo": 5, "done": [], "stats": {}}')
    s = "todo array<struct<p:string>>, done array<struct<p:string>>, stats struct<records:long>"
    x = o.select("o_orderkey", snap.alias("raw")).withColumn("v", F.try_parse_json("raw")).withColumn("s", F.from_json("raw", s))
    kind = lambda f: F.coalesce(F.schema_of_variant(F.expr(f"try_variant_get(v, '$.{f}', 'variant')")), F.lit(""))
    problems = F.array_compact(F.array(
        F.when(F.col("v").isNull(), "unparsable"),
        F.when(F.col("v").isNotNull() & ~kind("todo").startswith("ARRAY"), "todo"),
        F.when(F.col("v").isNotNull() & ~kind("done").startswith("ARRAY"), "done"),
        F.when(F.col("s.stats.records") < 0, "stats.records"),
        F.when(F.exists(F.coalesce("s.todo", F.array().cast("array<struct<p:string>>")), lambda e: e.p.isNull()), "todo.p"),
    ))
    return x.select("o_orderkey", F.explode(problems).alias("problem"))


QUERIES = {k: v for k, v in list(globals().items()) if k[:4] == "txt_"}
_HOST = r"lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))"
_ZLINES = "ln AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents)"
def _fact_sql(item):
    name, p = item[0], item[1].replace("'", "''")
    found = [f"regexp_extract_all(line, '{p}', {i})" for i in groups(item[1])]
    return f"SELECT doc_id, no, '{name}' AS name, i, [{', '.join(f'({x})[i]' for x in found)}] AS parts FROM (SELECT *, unnest(range(1, len({found[0]}) + 1)) AS i FROM al)"


SQL = {
    "txt_01_html_text": f"SELECT page_id, {_TEXT} AS text FROM pages",
    "txt_02_html_plain": f"SELECT page_id, md5(array_to_string(list_slice([{', '.join(f"'{b}'" for _, b in REFERENCES)}], 1, length(html) % {len(REFERENCES) + 1}), '|') || chr(10) || {_PLAIN}) AS md5 FROM pages",
    "txt_03_title": f"SELECT page_id, {_TITLE} AS title FROM pages",
    "txt_04_links": f"WITH {LINKS_SQL} SELECT page_id, link FROM li WHERE link IS NOT NULL",
    "txt_05_images": r"""WITH h AS (SELECT page_id, '<img a="1" src="/i?a=1&amp;b=2"><img src="/x.png"><img src="/x.png">' || html AS html FROM pages),
      l AS (SELECT page_id, list_transform(list_concat(list_concat(regexp_extract_all(html, '<img[^>]+src="([^"]+)"', 1), regexp_extract_all(html, 'data-src="([^"]+)"', 1)), regexp_extract_all(html, 'content="(https?://[^"]+\.(?:png|jpg|jpeg|gif))"', 1)), lambda x: replace(x, '&amp;', '&')) AS a FROM h),
      u AS (SELECT page_id, unnest(a) AS image, generate_subscripts(a, 1) AS i FROM l), f AS (SELECT page_id, image, min(i) AS i FROM u GROUP BY 1, 2), r AS (SELECT page_id, image, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS pos FROM f) SELECT page_id, pos, image FROM r WHERE pos < 40""",
    "txt_06_squeeze": r"SELECT doc_id, md5(trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))) AS md5 FROM documents",
    "txt_07_search_rows": rf"""WITH p AS (SELECT page_id, length(html) % 5 AS n, regexp_extract_all(html, '{_ANCHOR}', 1) AS h, regexp_extract_all(html, '{_ANCHOR}', 2) AS t FROM pages), a AS (SELECT page_id, n, unnest(h) AS h, unnest(t) AS t, unnest(range(len(h))) AS i FROM p),
      b AS (SELECT page_id, n, i, CASE WHEN i % 7 = 3 THEN 'javascript:;' WHEN i % 5 = 2 THEN '/link?url=' || h WHEN i % 2 = 0 THEN 'http://x.org' || h ELSE h END AS href, {_entities("t", (*T.ENTITIES[1:], ("&copy;", "©"), ("&middot;", "·"), T.ENTITIES[0]))} AS t FROM a),
      c AS (SELECT page_id, n, i, CASE WHEN n = 1 AND starts_with(href, '/') THEN 'https://www.sogou.com' || replace(href, '&amp;', '&') ELSE replace(href, '&amp;', '&') END AS href, trim(regexp_replace(t, '\s+', ' ', 'g')) AS title FROM b WHERE href <> ''),
      k AS (SELECT * FROM c WHERE NOT starts_with(href, 'javascript') AND length(title) >= CASE WHEN n = 3 THEN 4 ELSE 1 END AND (n NOT IN (2, 3) OR starts_with(href, 'http')) AND (n <> 4 OR starts_with(href, '/link?url=')) QUALIFY n <> 3 OR row_number() OVER (PARTITION BY page_id, substr(href, 1, 400) ORDER BY i) = 1)
      SELECT page_id, (['so360', 'sogou', 'bing', 'brave', 'weixin'])[n + 1] AS form, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS at, href, title, CASE WHEN n = 4 AND i % 2 = 0 THEN 'by ' || i END AS account, CASE WHEN n = 4 AND i % 3 = 0 THEN ('17' || i)::BIGINT END AS epoch, CASE WHEN n = 4 AND i % 4 = 0 THEN 'some digest' END AS digest FROM k""",
    "txt_09_article": r"""SELECT page_id, substr(coalesce(nullif(regexp_extract(html, 'og:title" content="([^"]*)"', 1), ''), nullif(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), ''), nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), ''), ''), 1, 80) AS title,
      md5(CASE WHEN strpos(html, '<article') > 0 THEN substr(html, strpos(html, '<article'), 400000) ELSE substr(html, 1, 400000) END) AS body_md5 FROM pages""",
    "txt_11_relevance": f"SELECT doc_id, ({_REL}) / 100 AS rel FROM (SELECT doc_id, substr(text, 1, 50000) AS t FROM documents)",
    "txt_12_confidence": f"""WITH {LEADS} SELECT doc_id, floor((greatest(50, least(1000, 7 * ({_REL}) + CASE kind WHEN 'qq_link' THEN 250 WHEN 'tg_link' THEN 200 WHEN 'wx_hint' THEN -100 ELSE 0 END + CASE WHEN contains(evidence, 'of') THEN 150 ELSE 0 END)) + 5) / 10) / 100 AS conf
      FROM (SELECT *, substr(text, 1, 50000) AS t FROM leads)""",
    "txt_13_watch_words": "SELECT doc_id, word, n FROM (SELECT doc_id, word, (length(lower(text)) - length(replace(lower(text), lower(word), ''))) // length(word) AS n FROM documents, (VALUES ('the'), ('Que'), ('UND'), ('zzz')) w(word)) WHERE n > 0",
    "txt_14_fingerprints": "SELECT doc_id, sha256(text) AS sha256, sha1(text) AS sha1, substr(sha256(text), 1, 12) AS sha12 FROM documents",
    "txt_15_to_epoch": """WITH e AS (SELECT (['1735689600', '1735689600.25', '2025-01-01T00:00:00Z', '2025-01-01T08:00:00+08:00', '2025-01-01T00:00:00', 'junk', ''])[event_id % 7 + 1] AS v FROM events)
      SELECT v, coalesce(try_cast(v AS DOUBLE), CASE WHEN regexp_matches(v, 'Z$') OR regexp_matches(v, '[+-][0-9]{2}:[0-9]{2}$') THEN 1735689600.0 WHEN regexp_matches(v, '^[0-9]{4}-') THEN epoch(v::TIMESTAMP) - 28800 END) AS epoch, count(*) AS n FROM e GROUP BY 1, 2""",
    "txt_16_iso": "SELECT event_id, strftime(to_timestamp(floor(epoch(ts))) AT TIME ZONE 'UTC' + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S') || '+08:00' AS iso FROM events",
    "txt_17_host": f"SELECT page_id, {_HOST} AS host FROM pages",
    "txt_18_hex_param": "SELECT page_id, CASE WHEN page_id % 3 < 2 THEN page_id::VARCHAR END AS id FROM pages",
    "txt_19_verdict": "SELECT doc_id, toxic = 1 AS intl, 'c' || quality AS category FROM labels",
    "txt_20_header": "SELECT doc_id, sha256(text) AS sha, true AS same FROM documents",
    "txt_21_tolerances": "SELECT o_orderkey, greatest(2, floor(floor(o_totalprice) * 0.015))::BIGINT AS leaf, greatest(100, floor(floor(o_totalprice) * 0.02))::BIGINT AS branch FROM orders",
    "txt_22_log_facts": f"""WITH {_ZLINES}, {REQUESTS}, al AS (SELECT doc_id, no, line FROM ln UNION ALL SELECT -event_id, 0, CASE WHEN status IS NULL THEN 'EXC ' || exc || ': ' || msg WHEN status >= 400 THEN 'HTTP ' || status || ' q=' || domain
      WHEN event_type = 'view' THEN '叶子 ''' || domain || ''' total=' || lim || ' 唯一=' || attempt ELSE '[throttle] mode=' || event_type || ' interval=' || attempt || '.5s' END FROM req),
      h AS ({" UNION ALL ".join(map(_fact_sql, PATTERNS.items()))}), f AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY doc_id, no, i) AS r FROM h)
      SELECT name, count(*) AS n, count(*) FILTER (len(list_filter(parts, lambda x: regexp_matches(x, '^[0-9.]+$'))) > 0) AS numeric, string_agg(array_to_string(parts, '|'), ',' ORDER BY r) FILTER (r <= 3) AS samples FROM f GROUP BY 1""",
    "txt_24_progress_problems": "SELECT o_orderkey, unnest(CASE o_orderkey % 5 WHEN 0 THEN ['todo.p'] WHEN 1 THEN ['done', 'stats.records'] WHEN 2 THEN ['unparsable'] WHEN 3 THEN [] ELSE ['todo'] END) AS problem FROM orders",
}
