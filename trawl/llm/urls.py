"""URL filters: host reputation by empirical Bayes, with DataFrame functions only.

Every page has an outcome, bad or good: that of a column of labels where one is given, else that of signs on the page. A page
is bad when one of these signs shows: symbols of the kind that garbled pages repeat make up more than one in NOISE of its characters;
its path has a word of WORDS; it has markup but fewer than THIN characters of text; it has more than one link for
each CROWDED characters of text. The host's name is no sign: what
is estimated for a host rests on its pages alone. Pages without html have no outcome. Bad rates are shrunk level by level: the suffix towards the
corpus, the registered domain towards its suffix, the host towards its domain, each as the mean of a beta-binomial
posterior whose prior strength is estimated from the spread of that level (method of moments). A host is blocked
when the lower bound of its posterior bad rate is above LIFT times the corpus' own bad rate (at most HIGHEST). List rules come first: the longest that fits wins.

Nulls: a null url, or one without "://", has an empty host and path; no rule fits it, and its reputation is that
of all such pages. Repeated rows count as often as they occur. An empty table gives an empty result. Very long urls and pages
are read whole. Ties between rules of one length can't be: two rules that fit one url and have one length are one rule. Columns of the
pages stay, whatever their names: what judge() adds is in one struct column, whose name is a parameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import skew_join, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Signs of a bad page.
SYMBOLS, NOISE, THIN, CROWDED = "%#$*", 25, 60, 40
WORDS = ("ads", "adserver", "adult", "bet", "bets", "casino", "cialis", "crack", "escort", "lottery", "malware", "phish", "pills", "poker", "porn", "sex", "slots", "spam", "tracker", "viagra", "warez", "xxx")
#: Labels that make a suffix of two labels together with a country code (such as co.uk).
SECOND = ("ac", "co", "com", "ed", "edu", "gen", "go", "gob", "gov", "gv", "id", "info", "mil", "ne", "net", "nom", "or", "org", "plc", "ltd", "sch", "web")
#: A host is blocked when mean - Z * sd of its posterior bad rate is above LIFT * the corpus' bad rate, or HIGHEST.
Z, LIFT, HIGHEST = 1.645, 3.0, 0.5
#: Bounds of the estimated prior strength, in pages.
WEAKEST, STRONGEST = 2.0, 200.0
_DOUBLE = rf"(?:^|\.)((?:{'|'.join(SECOND)})\.[a-z][a-z])(?::[0-9]*)?$"
_DOUBLE_DOMAIN = rf"([^.:]+\.(?:{'|'.join(SECOND)})\.[a-z][a-z])(?::[0-9]*)?$"
_WORD = rf"(^|[^a-z])({'|'.join(WORDS)})([^a-z]|$)"
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))


def host_of(url):
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url):
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host):
    """The public suffix, by rule: a generic label with a country code, else the last label."""
    double = F.regexp_extract(host, _DOUBLE, 1)
    return F.when(double != "", double).otherwise(F.regexp_extract(host, r"([^.:]+)(:[0-9]*)?$", 1))


def domain_of(host):
    """The suffix and one label more; the host itself where it has no more, or is an address."""
    two, three = F.regexp_extract(host, r"([^.:]+\.[^.:]+)(:[0-9]*)?$", 1), F.regexp_extract(host, _DOUBLE_DOMAIN, 1)
    out = F.when(F.regexp_extract(host, _DOUBLE, 1) != "", three).otherwise(two)
    return F.when((out == "") | host.rlike(r"^[0-9.]+(:[0-9]*)?$"), host).otherwise(out)


def rule_of(host, path, rules=RULES):
    """(rule, verdict) of the longest rule that fits; nulls where none does."""
    rule = verdict = None
    for what, at, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        rule = (rule.when(fits, at + start) if rule is not None else F.when(fits, at + start))
        verdict = (verdict.when(fits, what) if verdict is not None else F.when(fits, what))
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def bad_page(url, html):
    """1 for a page with a bad sign, 0 for another, null without html."""
    noise = F.length(html) - F.length(F.translate(html, SYMBOLS, ""))
    text = F.length(F.regexp_replace(html, "<[^>]*>", ""))
    links = (F.length(html) - F.length(F.replace(html, F.lit("<a "), F.lit("")))) / 3
    words = F.translate(path_of(url), UPPER, LOWER).rlike(_WORD)
    bad = (noise * NOISE > F.length(html)) | words | (text < THIN) | (links * CROWDED > text)
    return F.when(html.isNull(), None).when(bad, 1).otherwise(0)


def _strength(level: DataFrame) -> tuple[float, float]:
    """The overall bad rate, and the prior strength that the spread of this level's rates implies."""
    p = F.col("bad") / F.col("n")
    # sums over integers and per-group rates, one row to the driver
    r = level.where("n > 0").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count("*").alias("k"), F.avg(p).alias("m"), F.var_pop(p).alias("v"), F.avg(1 / F.col("n")).alias("inv")).first()
    if not r.n:
        return 0.5, WEAKEST
    m, within = r.m, r.m * (1 - r.m) * r.inv
    between = r.v - within
    s = STRONGEST if between <= 0 else m * (1 - m) / between - 1
    return (r.bad + 0.5) / (r.n + 1.0), min(STRONGEST, max(WEAKEST, s))


def reputation(outcomes: DataFrame) -> DataFrame:
    """Rows (host, bad), bad in 0, 1 or null -> one row per host: n, n_bad, bad_rate, bad_bound.

    Only counts per host leave the map side; domains and suffixes are summed from these. pages: the rows of each host; base: the corpus' bad rate."""
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.count("*").alias("pages"))
    hosts = staged(hosts.select("*", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix")), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    (base, s0), (_, s1), (_, s2) = _strength(suffixes), _strength(domains), _strength(hosts)
    rate = lambda prior, s: (F.col("bad") + s * prior) / (F.col("n") + s)
    top = suffixes.select("suffix", rate(F.lit(base), s0).alias("suffix_rate"))
    mid = domains.join(top, "suffix").select("domain", "suffix", rate(F.col("suffix_rate"), s1).alias("domain_rate"))
    a, b = F.col("bad") + s2 * F.col("domain_rate"), F.col("n") - F.col("bad") + s2 * (1 - F.col("domain_rate"))
    mean = a / (a + b)
    bound = mean - Z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return hosts.join(mid, ["domain", "suffix"]).select("host", "pages", "n", F.col("bad").alias("n_bad"), mean.alias("bad_rate"), bound.alias("bad_bound"), (bound > min(HIGHEST, LIFT * base)).alias("blocked"))


def judge(pages: DataFrame, url: str = "url", html: str = "html", rules=RULES, outcome: str | None = None, name: str = "judged") -> DataFrame:
    """The pages, with their columns, and a struct: host, path, rule, verdict, and the host's figures. outcome: a column of labels, 1 for bad, 0 for good, null for unknown."""
    u = F.col(url)
    keyed = pages.select(F.struct(*pages.columns).alias("page"), host_of(u).alias("host"))
    bad = F.col(outcome) if outcome else bad_page(u, F.col(html))
    scores = staged(reputation(pages.select(host_of(u).alias("host"), bad.alias("bad"))), "reputation")
    total = scores.agg(F.coalesce(F.sum("pages"), F.lit(0))).first()[0]
    out = skew_join(keyed, scores, "host", "pages", total)
    path = path_of(F.col("page")[url])
    rule, verdict = rule_of(F.col("host"), path, rules)
    return out.select("page.*", F.struct("host", path.alias("path"), rule.alias("rule"), F.coalesce(verdict, F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"), "n", "n_bad", "bad_rate", "bad_bound").alias(name))
