"""Column expressions that classify requests, pages, links and leads. Rule order matters in every chain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status codes by class.
LIMITED = (429,)
TRANSIENT = (408, 500, 502, 503, 504, 522, 524)
FATAL = (400, 401, 403, 404, 405, 410, 422)
#: Fixed values: (base, factor, cap) seconds of the wait by class, and who waits.
BACKOFF = {
    "dns": (2.0, 2.0, 30.0), "conn_reset": (2.0, 2.0, 30.0), "read_timeout": (1.0, 2.0, 15.0), "write_timeout": (1.0, 2.0, 15.0), "server_5xx": (5.0, 2.0, 60.0), "ratelimit": (15.0, 2.0, 60.0),
    "auth": (15.0, 2.0, 60.0), "client": (2.0, 2.0, 20.0), "other": (2.0, 2.0, 20.0), "fatal": (0.0, 1.0, 0.0), "data": (0.0, 1.0, 0.0),
}
# Signs in page bodies.
BLOCK_CJK = ("百度安全验证", "验证码", "请输入验证码", "人机验证", "滑动验证", "安全检测", "访问过于频繁", "请稍后再试", "出错了")
BLOCK_LATIN = ("wappass", "security check", "verify you are human", "unusual traffic")
CHALLENGE = ("challenge-platform", "cf-challenge", "turnstile", "geo.captcha-delivery.com", "window._cf_chl", "datadome", "checking your browser", "just a moment", "captcha")
SOFT = ("访问过于频繁", "请稍后再试", "出错了", "too many requests", "rate limit")
LOGIN = ("sign in - google accounts", "use your google account")
#: Exception names and message parts by class, most specific first.
EXCEPTIONS = (
    ("dns", ("NameResolutionError", "gaierror"), ("name resolution", "name or service not known", "nodename nor servname", "getaddrinfo", "no address associated", "failed to resolve", "name does not resolve")),
    ("conn_reset", ("ConnectTimeout", "ConnectTimeoutError"), ("connect timeout", "connection timeout", "connect timed out", "timeout during connect", "timed out during connect")),
    ("data", ("JSONDecodeError", "InvalidJSONError", "ContentDecodingError", "UnicodeDecodeError", "ValueError", "KeyError", "IndexError", "TypeError", "AttributeError"), ()),
    ("write_timeout", ("WriteTimeout", "WriteTimeoutError"), ("write timed out", "writetimeout", "write timeout")),
    ("read_timeout", ("ReadTimeout", "ReadTimeoutError", "Timeout", "TimeoutError", "timeout"), ("read timed out", "readtimeout", "read timeout", "timed out", "timeout")),
    ("conn_reset", ("ConnectionError", "ConnectionResetError", "ConnectionAbortedError", "RemoteDisconnected", "ProtocolError", "SSLError", "SSLEOFError", "ProxyError", "NewConnectionError", "MaxRetryError", "IncompleteRead", "ChunkedEncodingError", "BrokenPipeError", "ConnectionRefusedError"),
     ("connection reset", "connection aborted", "connection refused", "connection error", "remote end closed", "remote disconnected", "eof occurred", "bad status line", "tunnel connection failed", "broken pipe", "ssl", "certificate", "proxy")),
)
#: Link kinds by URL pattern, first match wins.
PLATFORMS = (("tg_link", r"t\.me/"), ("fb_group", r"facebook\.com/groups/"), ("fb_page", r"facebook\.com/(?!groups)"), ("wa_link", r"chat\.whatsapp\.com|wa\.me|whatsapp\.com/channel"), ("dc_link", r"discord\.(gg|com/invite)"), ("ig_page", r"instagram\.com/"))


def contains_any(c: Column, parts: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | c.contains(p)
    return out


def status_class(s: Column) -> Column:
    """ok, limited, transient, fatal or unknown."""
    return (
        F.when(s.between(200, 299), "ok").when(s.isin(*LIMITED), "limited").when(s.isin(*TRANSIENT), "transient").when(s.isin(*FATAL), "fatal").when(s.between(400, 499), "fatal").when(s >= 500, "transient").otherwise("unknown")
    )


def retry_class(s: Column) -> Column:
    """ratelimit, client, auth, server_5xx, fatal or other."""
    return F.when(s == 429, "ratelimit").when(s == 400, "client").when(s.isin(401, 403), "auth").when(s.between(500, 599), "server_5xx").when(s.between(300, 499), "fatal").otherwise("other")


def exception_class(name: Column, message: Column) -> Column:
    """transient or unknown, from an exception's type name and message."""
    name, message = F.lower(F.coalesce(name, F.lit(""))), F.lower(F.coalesce(message, F.lit("")))
    hit = contains_any(name, ("timeout", "timedout", "connection", "socket", "ssl", "eof")) | contains_any(message, ("timed out", "timeout", "connection reset", "connection aborted", "remote end closed", "temporary failure"))
    return F.when(hit, "transient").otherwise("unknown")


def failure_class(names: Column, message: Column) -> Column:
    """Ordered rules over an exception's type names (an array) and message."""
    message = F.lower(F.coalesce(message, F.lit("")))
    out = None
    for cls, types, parts in EXCEPTIONS:
        hit = F.coalesce(F.arrays_overlap(names, F.array(*map(F.lit, types))), F.lit(False)) | contains_any(message, parts)
        out = F.when(hit, cls) if out is None else out.when(hit, cls)
    return out.otherwise("other")


def body_class(body: Column) -> Column:
    """blocked, challenge, soft_limit or null, from the first 8000 characters."""
    head = F.substring(body, 1, 8000)
    low = F.lower(head)
    return F.when(contains_any(head, BLOCK_CJK) | contains_any(low, BLOCK_LATIN), "blocked").when(contains_any(low, CHALLENGE), "challenge").when(contains_any(head, SOFT), "soft_limit")


def visible_chars(html: Column) -> Column:
    out = F.regexp_replace(html, r"(?is)<script.*?</script>", " ")
    out = F.regexp_replace(out, r"(?is)<style.*?</style>", " ")
    return F.length(F.regexp_replace(F.regexp_replace(out, r"<[^>]+>", " "), r"(?U)\s+", ""))


def empty_shell(html: Column, min_visible: int = 200) -> Column:
    return F.coalesce(visible_chars(html) < min_visible, F.lit(True))


def login_page(html: Column) -> Column:
    return contains_any(F.lower(F.substring(F.coalesce(html, F.lit("")), 1, 6000)), LOGIN)


def outcome(status: Column, body: Column, exc_name: Column, exc_message: Column) -> Column:
    """A fetch's class: the body's signs override a 2xx, an exception replaces the status."""
    by_status = status_class(status)
    by_body = body_class(body)
    return F.when(status.isNull(), exception_class(exc_name, exc_message)).when(by_status == "ok", F.when(by_body.isin("blocked", "challenge"), "blocked").when(by_body == "soft_limit", "limited").otherwise("ok")).when(status.isin(301, 302, 303, 307, 308), "ok").otherwise(by_status)


def next_action(cls: Column, status: Column, err: Column, page_empty: Column, signature_error: Column | None = None) -> Column:
    """struct(action, reason) that follows from a fetch; signature_error: the page says that the request was signed wrongly."""
    step = lambda a, r: F.struct(F.lit(a).alias("action"), (F.lit(r) if isinstance(r, str) else r).alias("reason"))
    return (
        F.when((cls == "ok") & (F.lit(False) if signature_error is None else signature_error), step("needs_reverse", "signature_error_marker"))
        .when((cls == "ok") & page_empty, step("escalate_browser", "empty_shell"))
        .when(cls == "ok", step("ok", "success"))
        .when(cls == "channel", step("switch_egress", "channel_unavailable"))
        .when(cls == "circuit_open", step("retry_later", "circuit_cooldown"))
        .when((cls == "blocked") & F.coalesce(err, F.lit("")).contains("CHALLENGE"), step("escalate_browser", "challenge_page"))
        .when(cls == "blocked", step("retry_later", "block_sign_cooldown"))
        .when(cls == "limited", step("retry_later", "rate_limited"))
        .when(cls == "transient", step("retry_later", "transient_exhausted"))
        .when((cls == "fatal") & (status == 403), step("escalate_browser", "forbidden_waf_suspect"))
        .when(cls == "fatal", step("give_up", "fatal_status"))
        .otherwise(step("retry_later", F.concat(F.lit("unknown_cls:"), F.coalesce(cls, F.lit("")))))
    )


def wait_band(cls: Column, attempt: Column) -> tuple[Column, Column]:
    """(least, most) seconds before a retry: half of d to d, d = min(cap, base * factor ** attempt)."""
    of = lambda i: F.element_at(F.create_map(*[F.lit(x) for k, v in BACKOFF.items() for x in (k, v[i])]), cls)
    d = F.least(of(2), of(0) * F.pow(of(1), attempt))
    return d / 2, d


def should_retry(cls: Column) -> Column:
    return cls.isin("transient", "limited", "unknown")


def platform(url: Column, rules=PLATFORMS) -> Column:
    out = None
    for kind, pattern in rules:
        out = F.when(url.rlike(pattern), kind) if out is None else out.when(url.rlike(pattern), kind)
    return out


def bad_lead(kind: Column, value: Column, blacklist: Sequence[str] = ()) -> Column:
    """Malformed identifiers: names by prefix, blacklist and form, numbers by form."""
    name = value.startswith("_") | F.lower(value).isin(*blacklist, "") | ~value.rlike(r"^[A-Za-z][A-Za-z0-9_-]{4,29}$")
    return F.coalesce(F.when(kind == "wx_hint", name).when(kind == "qq_num", ~value.rlike(r"^\d{5,10}$")), F.lit(False))


def missing(*cols: Column) -> Column:
    """True where any of these is null or empty."""
    out = F.lit(False)
    for c in cols:
        out = out | c.isNull() | (c.cast("string") == "")
    return out


def evidence_missing(kind: Column, value: Column, evidence: Column, exempt_kinds=("qq_link", "fb_page"), exempt_sign="QR→") -> Column:
    return ~(F.coalesce(evidence.contains(value), F.lit(False)) | kind.isin(*exempt_kinds) | F.coalesce(evidence.contains(exempt_sign), F.lit(False)))


def host_allowed(host: Column, suffixes: Sequence[str]) -> Column:
    """By suffix of the string, not by label."""
    return F.exists(F.array(*map(F.lit, suffixes)), lambda x: host.endswith(x))


def domains_of(kind: Column, src: Column, groups: dict[str, Sequence[str]], by_kind: dict[str, Sequence[str]]) -> Column:
    """All coverage domains of a lead; 'other' if none."""
    low = F.lower(src)
    hits = [F.when(contains_any(low, keys) | kind.isin(*by_kind.get(d, ()), ""), F.lit(d)) for d, keys in groups.items()]
    found = F.array_compact(F.array(*hits))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("other")))


def size_class(limit: Column) -> Column:
    return F.when(limit >= 50, "bulk").otherwise("light")


def observed(status: Column, failed: Column) -> Column:
    """What the limiter sees: rlimit, conn, 5xx, other, or null for success."""
    return F.when(failed, "conn").when(status == 429, "rlimit").when(status >= 500, "5xx").when(status >= 400, "other")
