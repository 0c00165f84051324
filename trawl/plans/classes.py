"""Classification queries: CLS and FLT."""

from pyspark.sql import functions as F

from trawl.functions import classify as C
from trawl.plans.tables import REQUESTS, read, requests


def cls_01_status_class(spark, d):
    return requests(spark, d).groupBy("status", C.status_class(F.col("status")).alias("cls")).agg(F.count("*").alias("n"))


def cls_02_retry_class(spark, d):
    return requests(spark, d).groupBy("status", C.retry_class(F.col("status")).alias("cls")).agg(F.count("*").alias("n"))


def cls_03_exception_class(spark, d):
    return requests(spark, d).groupBy("exc", "msg", C.exception_class(F.col("exc"), F.col("msg")).alias("cls")).agg(F.count("*").alias("n"))


def cls_04_failure_class(spark, d):
    return requests(spark, d).groupBy("exc", "msg", C.failure_class(F.array("exc"), F.col("msg")).alias("cls")).agg(F.count("*").alias("n"))


def _signed(spark, d):
    """Pages whose body has a sign planted by page_id."""
    p = read(spark, d, "pages")
    sign = F.element_at(F.array(*map(F.lit, SIGNS)), (F.col("page_id") % len(SIGNS) + 1).cast("int"))
    return p.select("page_id", "url", "html", F.concat(sign, F.lit(" "), "html").alias("body"))


SIGNS = ("", "Verify You Are Human", "请稍后再试", "Just A Moment", "rate limit", "Rate Limit", "captcha", "Sign in - Google Accounts")
_SIGNS = "[" + ", ".join(f"'{s}'" for s in SIGNS) + "]"
_SIGNED = f"pg AS (SELECT page_id, url, html, ({_SIGNS})[page_id % {len(SIGNS)} + 1] || ' ' || html AS body FROM pages)"
_any = lambda c, parts: "(" + " OR ".join(f"contains({c}, '{p}')" for p in parts) + ")" if parts else "false"
_HEAD, _LOW = "substr(body, 1, 8000)", "lower(substr(body, 1, 8000))"
_BODY = f"CASE WHEN {_any(_HEAD, C.BLOCK_CJK)} OR {_any(_LOW, C.BLOCK_LATIN)} THEN 'blocked' WHEN {_any(_LOW, C.CHALLENGE)} THEN 'challenge' WHEN {_any(_HEAD, C.SOFT)} THEN 'soft_limit' END"
_STATUS = "CASE WHEN status BETWEEN 200 AND 299 THEN 'ok' WHEN status = 429 THEN 'limited' WHEN status IN (408, 500, 502, 503, 504, 522, 524) THEN 'transient' WHEN status BETWEEN 400 AND 499 THEN 'fatal' WHEN status >= 500 THEN 'transient' ELSE 'unknown' END"
_EXC = f"CASE WHEN {_any('lower(exc)', ('timeout', 'timedout', 'connection', 'socket', 'ssl', 'eof'))} OR {_any('lower(msg)', ('timed out', 'timeout', 'connection reset', 'connection aborted', 'remote end closed', 'temporary failure'))} THEN 'transient' ELSE 'unknown' END"
_RETRY = "CASE WHEN status = 429 THEN 'ratelimit' WHEN status = 400 THEN 'client' WHEN status IN (401, 403) THEN 'auth' WHEN status BETWEEN 500 AND 599 THEN 'server_5xx' WHEN status BETWEEN 300 AND 499 THEN 'fatal' ELSE 'other' END"
_FAIL = "CASE " + " ".join(f"WHEN exc IN ({', '.join(repr(t) for t in types)}) OR {_any('lower(msg)', parts)} THEN '{c}'" for c, types, parts in C.EXCEPTIONS) + " ELSE 'other' END"
_VISIBLE = r"length(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script.*?</script>', ' ', 'g'), '(?is)<style.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\s+', '', 'g'))"


def cls_05_body_class(spark, d):
    return _signed(spark, d).select("page_id", C.body_class(F.col("body")).alias("cls"))


def cls_06_empty_shell(spark, d):
    return read(spark, d, "pages").select("page_id", C.visible_chars(F.col("html")).alias("visible"), C.empty_shell(F.col("html"), 1200).alias("shell"))


def cls_07_login_page(spark, d):
    return _signed(spark, d).select("page_id", C.login_page(F.col("body")).alias("login"))


def cls_08_outcome(spark, d):
    r = requests(spark, d).select("event_id", "status", "exc", "msg", (F.col("event_id") % 8).alias("sign"))
    r = r.select("*", F.element_at(F.array(*map(F.lit, SIGNS)), (F.col("sign") + 1).cast("int")).alias("body"))
    return r.select("event_id", C.outcome(F.col("status"), F.col("body"), F.col("exc"), F.col("msg")).alias("cls"))


_OUT = f"CASE WHEN status IS NULL THEN {_EXC} WHEN status BETWEEN 200 AND 299 THEN CASE WHEN ({_BODY}) IN ('blocked', 'challenge') THEN 'blocked' WHEN ({_BODY}) = 'soft_limit' THEN 'limited' ELSE 'ok' END WHEN status IN (301, 302, 303, 307, 308) THEN 'ok' ELSE {_STATUS} END"


def cls_09_next_action(spark, d):
    r = requests(spark, d).select("event_id", "status", F.element_at(F.array(*map(F.lit, CLASSES)), (F.col("event_id") % len(CLASSES) + 1).cast("int")).alias("cls"), F.when(F.col("event_id") % 5 == 0, "CHALLENGE: x").alias("err"), (F.col("event_id") % 6 == 0).alias("empty"), (F.col("event_id") % 16 == 0).alias("badly_signed"))
    return r.select("event_id", C.next_action(F.col("cls"), F.col("status"), F.col("err"), F.col("empty"), F.col("badly_signed")).alias("s")).select("event_id", "s.action", "s.reason")


CLASSES = ("ok", "channel", "circuit_open", "blocked", "limited", "transient", "fatal", "unknown")


def cls_10_wait_band(spark, d):
    r = requests(spark, d).select(C.retry_class(F.col("status")).alias("cls"), "attempt")
    lo, hi = C.wait_band(F.col("cls"), F.col("attempt"))
    return r.groupBy("cls", "attempt").agg(F.count("*").alias("n")).select("cls", "attempt", "n", lo.alias("lo"), hi.alias("hi"))


_BANDS = "(VALUES " + ", ".join(f"('{k}', {b}, {f}, {c})" for k, (b, f, c) in C.BACKOFF.items()) + ") b(cls, base, factor, cap)"
LINKS = ("https://t.me/x", "http://facebook.com/groups/1", "http://facebook.com/page", "https://wa.me/1", "https://discord.gg/a", "https://instagram.com/b", "https://example.com/")


def cls_11_platform(spark, d):
    p = read(spark, d, "pages").select("page_id", F.concat(F.element_at(F.array(*map(F.lit, LINKS)), (F.col("page_id") % len(LINKS) + 1).cast("int")), F.lit("?u="), "url").alias("link"))
    return p.select("page_id", C.platform(F.col("link")).alias("kind"))


_LINKS = "[" + ", ".join(f"'{s}'" for s in LINKS) + "]"


def _leads(spark, d):
    """documents as leads: kind and value by doc_id, the text's head as evidence."""
    x = read(spark, d, "documents")
    n = F.col("doc_id")
    return x.select(
        "doc_id", F.element_at(F.array(*map(F.lit, KINDS)), (n % len(KINDS) + 1).cast("int")).alias("kind"), F.get(F.split("text", r"[ \n]"), 1).alias("value"), F.col("text").alias("evidence"), F.col("source").alias("src"), (n % 100 / 100).alias("conf"), "text",
    ).withColumn("value", F.when(n % 10 == 3, F.concat(F.lit("_"), "value")).when(n % 10 == 4, F.lpad((n * 7919).cast("string"), 6, "1")).when(n % 50 == 7, F.lit("")).otherwise(F.col("value")))


KINDS = ("wx_hint", "qq_num", "qq_link", "tg_link", "fb_page")
LEADS = """leads AS (SELECT doc_id, (['wx_hint', 'qq_num', 'qq_link', 'tg_link', 'fb_page'])[doc_id % 5 + 1] AS kind, CASE WHEN doc_id % 10 = 3 THEN '_' || w WHEN doc_id % 10 = 4 THEN CASE WHEN length((doc_id * 7919)::VARCHAR) > 6 THEN substr((doc_id * 7919)::VARCHAR, 1, 6) ELSE lpad((doc_id * 7919)::VARCHAR, 6, '1') END
  WHEN doc_id % 50 = 7 THEN '' ELSE w END AS value, text AS evidence, source AS src, (doc_id % 100) / 100 AS conf, text FROM (SELECT *, (regexp_split_to_array(text, '[ \\n]'))[2] AS w FROM documents))"""
BLACKLIST = ("report", "function", "script", "the", "with")


def flt_01_bad_leads(spark, d):
    x = _leads(spark, d)
    return x.where(~C.bad_lead(F.col("kind"), F.col("value"), BLACKLIST)).select("doc_id", "kind", "value")


def flt_02_by_source(spark, d):
    return read(spark, d, "pages").where(~(F.col("url").contains("utm_source") | F.col("url").contains("blog."))).select("page_id", "url")


def flt_03_false_positives(spark, d):
    return _leads(spark, d).where(~F.col("value").isin("the", "de", "und")).groupBy("kind").agg(F.count("*").alias("n"))


def flt_04_required_fields(spark, d):
    x = _leads(spark, d)
    return x.where(C.missing(F.col("kind"), F.col("value"), F.col("src"))).select("doc_id", "kind")


def flt_05_evidence(spark, d):
    x = _leads(spark, d)
    return x.where(C.evidence_missing(F.col("kind"), F.col("value"), F.col("evidence"))).select("doc_id", "kind", "value")


def flt_06_recent(spark, d):
    e = read(spark, d, "events")
    now = e.agg(F.max("ts").alias("now"))
    # one row, broadcast
    return e.join(F.broadcast(now), e.ts > now.now - F.expr("INTERVAL 600 MINUTES")).select("event_id", "event_type")


def flt_07_host_suffix(spark, d):
    p = read(spark, d, "pages").select("page_id", F.lower(F.expr("try_parse_url(url, 'HOST')")).alias("host"))
    return p.where(C.host_allowed(F.col("host"), ("example.com", "th.example.org"))).select("page_id", "host")


def cls_12_promote(spark, d):
    x = _leads(spark, d)
    hit = F.col("evidence").contains("the ")
    promoted = x.where(hit).select("doc_id", F.lit("contact").alias("kind"), F.substring("evidence", 1, 200).alias("value"))
    return x.select("doc_id", "kind", "value").unionByName(promoted)


def cls_13_article_score(spark, d):
    """The title is a document's first line, the digest all that follows."""
    title = F.substring_index("text", "\n", 1)
    x = read(spark, d, "documents").select("doc_id", title.alias("title"), F.expr("substring(text, length(substring_index(text, '\n', 1)) + 2)").alias("digest"))
    p = "ingth|und der|que la"
    return x.select("doc_id", (F.col("title").rlike(p).cast("int") * 2 + F.coalesce(F.col("digest").rlike(p).cast("int"), F.lit(0))).alias("score"))


GROUPS = {"D1": ("src1", "src2"), "D2": ("src3",), "D4": (), "D5": ("src5", "src11")}
BY_KIND = {"D4": ("qq_num", "qq_link"), "D5": ("tg_link", "fb_page")}


def cls_14_domains(spark, d):
    x = _leads(spark, d).select("doc_id", F.explode(C.domains_of(F.col("kind"), F.col("src"), GROUPS, BY_KIND)).alias("domain"))
    return x


def ag_23_domain_counts(spark, d):
    x = cls_14_domains(spark, d).distinct().groupBy("domain").agg(F.count("*").alias("n"))
    return x.select("domain", "n", (F.col("n") >= 3).alias("productive"))


_DOMAINS = f"""dom AS (SELECT doc_id, 'D1' AS domain FROM leads WHERE contains(lower(src), 'src1') OR contains(lower(src), 'src2') UNION ALL SELECT doc_id, 'D2' FROM leads WHERE contains(lower(src), 'src3')
  UNION ALL SELECT doc_id, 'D4' FROM leads WHERE kind IN ('qq_num', 'qq_link') UNION ALL SELECT doc_id, 'D5' FROM leads WHERE contains(lower(src), 'src5') OR contains(lower(src), 'src11') OR kind IN ('tg_link', 'fb_page')),
doms AS (SELECT * FROM dom UNION ALL SELECT doc_id, 'other' FROM leads WHERE doc_id NOT IN (SELECT doc_id FROM dom))"""


def cls_15_section(spark, d):
    x = _leads(spark, d).join(read(spark, d, "labels"), "doc_id", "left")
    section = F.when(F.col("toxic") == 1, "core").when(F.col("quality") == 1, "related").otherwise("other")
    return x.groupBy(F.when(F.col("kind").isin("qq_num", "qq_link"), "groups").otherwise("contacts").alias("kind_group"), section.alias("section")).agg(F.count("*").alias("n"))


def cls_21_observed(spark, d):
    r = requests(spark, d)
    return r.groupBy(C.observed(F.col("status"), F.col("status").isNull()).alias("obs"), C.size_class(F.col("lim")).alias("size")).agg(F.count("*").alias("n"))


_list_ = lambda v: "[" + ", ".join(f"'{x}'" for x in v) + "]"
QUERIES = {k: v for k, v in list(globals().items()) if k[:4] in ("cls_", "flt_") or k == "ag_23_domain_counts"}
SQL = {
    "cls_01_status_class": f"WITH {REQUESTS} SELECT status, {_STATUS} AS cls, count(*) AS n FROM req GROUP BY 1, 2",
    "cls_02_retry_class": f"WITH {REQUESTS} SELECT status, {_RETRY} AS cls, count(*) AS n FROM req GROUP BY 1, 2",
    "cls_03_exception_class": f"WITH {REQUESTS} SELECT exc, msg, {_EXC} AS cls, count(*) AS n FROM req GROUP BY 1, 2, 3",
    "cls_04_failure_class": f"WITH {REQUESTS} SELECT exc, msg, {_FAIL} AS cls, count(*) AS n FROM req GROUP BY 1, 2, 3",
    "cls_05_body_class": f"WITH {_SIGNED} SELECT page_id, {_BODY} AS cls FROM pg",
    "cls_06_empty_shell": f"SELECT page_id, {_VISIBLE} AS visible, {_VISIBLE} < 1200 AS shell FROM pages",
    "cls_07_login_page": f"WITH {_SIGNED} SELECT page_id, {_any('lower(substr(body, 1, 6000))', C.LOGIN)} AS login FROM pg",
    "cls_08_outcome": f"WITH {REQUESTS}, r AS (SELECT *, ({_SIGNS})[event_id % 8 + 1] AS body FROM req) SELECT event_id, {_OUT} AS cls FROM r",
    "cls_09_next_action": f"""WITH {REQUESTS}, r AS (SELECT event_id, status, ({_list_(CLASSES)})[event_id % 8 + 1] AS cls, event_id % 5 = 0 AS ch, event_id % 6 = 0 AS emp, event_id % 16 = 0 AS bad FROM req)
      SELECT event_id, split_part(a, '|', 1) AS action, split_part(a, '|', 2) AS reason FROM (SELECT event_id, CASE cls WHEN 'ok' THEN CASE WHEN bad THEN 'needs_reverse|signature_error_marker' WHEN emp THEN 'escalate_browser|empty_shell' ELSE 'ok|success' END WHEN 'channel' THEN 'switch_egress|channel_unavailable'
      WHEN 'circuit_open' THEN 'retry_later|circuit_cooldown' WHEN 'blocked' THEN CASE WHEN ch THEN 'escalate_browser|challenge_page' ELSE 'retry_later|block_sign_cooldown' END WHEN 'limited' THEN 'retry_later|rate_limited' WHEN 'transient' THEN 'retry_later|transient_exhausted'
      WHEN 'fatal' THEN CASE WHEN status = 403 THEN 'escalate_browser|forbidden_waf_suspect' ELSE 'give_up|fatal_status' END ELSE 'retry_later|unknown_cls:' || cls END AS a FROM r)""",
    "cls_10_wait_band": f"WITH {REQUESTS}, g AS (SELECT {_RETRY} AS cls, attempt, count(*) AS n FROM req GROUP BY 1, 2) SELECT cls, attempt, n, least(cap, base * pow(factor, attempt)) / 2 AS lo, least(cap, base * pow(factor, attempt)) AS hi FROM g JOIN {_BANDS} USING (cls)",
    "cls_11_platform": f"WITH l AS (SELECT page_id, ({_LINKS})[page_id % {len(LINKS)} + 1] || '?u=' || url AS link FROM pages) SELECT page_id, CASE WHEN contains(link, 't.me/') THEN 'tg_link' WHEN contains(link, 'facebook.com/groups/') THEN 'fb_group' WHEN contains(link, 'facebook.com/') THEN 'fb_page' WHEN regexp_matches(link, 'chat\\.whatsapp\\.com|wa\\.me|whatsapp\\.com/channel') THEN 'wa_link' WHEN regexp_matches(link, 'discord\\.(gg|com/invite)') THEN 'dc_link' WHEN contains(link, 'instagram.com/') THEN 'ig_page' END AS kind FROM l",
    "cls_12_promote": f"WITH {LEADS} SELECT doc_id, kind, value FROM leads UNION ALL SELECT doc_id, 'contact', substr(evidence, 1, 200) FROM leads WHERE contains(evidence, 'the ')",
    "cls_13_article_score": "SELECT doc_id, CASE WHEN regexp_matches(split_part(text, chr(10), 1), 'ingth|und der|que la') THEN 2 ELSE 0 END + CASE WHEN regexp_matches(substr(text, length(split_part(text, chr(10), 1)) + 2), 'ingth|und der|que la') THEN 1 ELSE 0 END AS score FROM documents",
    "cls_14_domains": f"WITH {LEADS}, {_DOMAINS} SELECT doc_id, domain FROM doms",
    "ag_23_domain_counts": f"WITH {LEADS}, {_DOMAINS} SELECT domain, count(DISTINCT doc_id) AS n, count(DISTINCT doc_id) >= 3 AS productive FROM doms GROUP BY 1",
    "cls_15_section": f"WITH {LEADS} SELECT CASE WHEN kind IN ('qq_num', 'qq_link') THEN 'groups' ELSE 'contacts' END AS kind_group, CASE WHEN toxic = 1 THEN 'core' WHEN quality = 1 THEN 'related' ELSE 'other' END AS section, count(*) AS n FROM leads LEFT JOIN labels USING (doc_id) GROUP BY 1, 2",
    "cls_21_observed": f"WITH {REQUESTS} SELECT CASE WHEN status IS NULL THEN 'conn' WHEN status = 429 THEN 'rlimit' WHEN status >= 500 THEN '5xx' WHEN status >= 400 THEN 'other' END AS obs, CASE WHEN lim >= 50 THEN 'bulk' ELSE 'light' END AS size, count(*) AS n FROM req GROUP BY 1, 2",
    "flt_01_bad_leads": f"WITH {LEADS} SELECT doc_id, kind, value FROM leads WHERE NOT coalesce(CASE kind WHEN 'wx_hint' THEN starts_with(value, '_') OR lower(value) IN {BLACKLIST} OR NOT regexp_full_match(value, '[A-Za-z][A-Za-z0-9_-]{{4,29}}') WHEN 'qq_num' THEN NOT regexp_full_match(value, '[0-9]{{5,10}}') END, false)",
    "flt_02_by_source": "SELECT page_id, url FROM pages WHERE NOT (contains(url, 'utm_source') OR contains(url, 'blog.'))",
    "flt_03_false_positives": f"WITH {LEADS} SELECT kind, count(*) AS n FROM leads WHERE value NOT IN ('the', 'de', 'und') GROUP BY 1",
    "flt_04_required_fields": f"WITH {LEADS} SELECT doc_id, kind FROM leads WHERE value IS NULL OR value = '' OR src IS NULL OR src = ''",
    "flt_05_evidence": f"WITH {LEADS} SELECT doc_id, kind, value FROM leads WHERE NOT (coalesce(contains(evidence, value), false) OR kind IN ('qq_link', 'fb_page') OR coalesce(contains(evidence, 'QR→'), false))",
    "flt_06_recent": "SELECT event_id, event_type FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 600 MINUTES",
    "flt_07_host_suffix": "SELECT page_id, host FROM (SELECT page_id, lower(regexp_extract(url, '://([^/?#:]*)', 1)) AS host FROM pages) WHERE ends_with(host, 'example.com') OR ends_with(host, 'th.example.org')",
}
