"""Result rows of search and article pages: what a page's form is, is data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions.text import ENTITIES, squeezed, unescaped


@dataclass(frozen=True)
class Form:
    """A page form: block finds a result; the other patterns are searched in it, each with one group, and those that are empty or find nothing give null."""

    block: str
    href: str
    title: str
    account: str = ""
    epoch: str = ""
    digest: str = ""
    #: put before links that begin with a stroke
    base: str = ""
    #: what a link must have, and mustn't
    accept: str = ""
    drop: str = r"^javascript"
    #: shortest title, and the most characters of title and link that are kept
    least: int = 1
    title_most: int = 0
    href_most: int = 0
    #: of equal links the first one stays
    once: bool = False


# The forms of pages that are read.
FORMS = {
    "so360": Form(r'(?s)<h3[^>]*class="[^"]*res-title[^"]*"[^>]*>\s*<a[^>]*href="[^"]+"[^>]*>.*?</a>', r'<a[^>]*href="([^"]+)"', r"(?s)<a[^>]*>(.*?)</a>"),
    "sogou": Form(r'(?s)<h3[^>]*>\s*<a[^>]*href="[^"]+"[^>]*>.*?</a>', r'<a[^>]*href="([^"]+)"', r"(?s)<a[^>]*>(.*?)</a>", base="https://www.sogou.com"),
    "bing": Form(r'(?s)<h2[^>]*><a[^>]*href="[^"]+"[^>]*>.*?</a></h2>', r'<a[^>]*href="([^"]+)"', r"(?s)<a[^>]*>(.*?)</a></h2>", accept=r"^http"),
    "brave": Form(r'(?s)<a[^>]+href="https?://[^"]+"[^>]*>.*?</a>', r'<a[^>]+href="(https?://[^"]+)"', r"(?s)<a[^>]*>(.*?)</a>", drop=r"brave\.com|search\.brave|javascript:", least=4, title_most=150, href_most=400, once=True),
    "weixin": Form(
        r'(?s)<h3>\s*<a[^>]*href="/link\?url=[^"]+"[^>]*>.*?</a>\s*</h3>.*?(?=<h3>|</ul>)', r'<a[^>]*href="(/link\?url=[^"]+)"', r"(?s)<h3>\s*<a[^>]*>(.*?)</a>", account=r'(?s)class="account"[^>]*>(.*?)</a>',
        epoch=r"document\.write\(timeConvert\('(\d+)'\)\)", digest=r'(?s)<p class="txt-info"[^>]*>(.*?)</p>',
    ),
}


def plain(c: Column) -> Column:
    """Text without tags, references as characters, blanks squeezed."""
    out = F.regexp_replace(c, r"<[^>]+>", " ")
    for a, b in (*ENTITIES[1:], ENTITIES[0]):
        out = F.replace(out, F.lit(a), F.lit(b))
    return squeezed(F.regexp_replace(out, r"[\r\n\t]+", " "))


def _found(block: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(block, pattern, 1), F.lit("")) if pattern else F.lit(None).cast("string")


def result_rows(pages: DataFrame, form: Form, html: str = "html") -> DataFrame:
    """pages with results: an array of (href, title, account, epoch, digest) in page order, empty where there are none. A page is unescaped and cut once."""

    def row(block: Column) -> Column:
        href = F.regexp_replace(F.regexp_extract(block, form.href, 1), r"\s+", "")
        href = F.replace(href, F.lit("&amp;"), F.lit("&"))
        href = F.when(href.startswith("/"), F.concat(F.lit(form.base), href)).otherwise(href) if form.base else href
        title, account, digest = (plain(_found(block, p)) for p in (form.title, form.account, form.digest))
        title = F.coalesce(title, F.lit(""))
        return F.struct(
            (F.substring(href, 1, form.href_most) if form.href_most else href).alias("href"), (F.substring(title, 1, form.title_most) if form.title_most else title).alias("title"),
            account.alias("account"), _found(block, form.epoch).cast("long").alias("epoch"), digest.alias("digest"),
        )

    x = pages.withColumn("_page", unescaped_but_markup(F.col(html)))
    x = x.withColumn("_rows", F.transform(F.regexp_extract_all("_page", F.lit(form.block), F.lit(0)), row))
    x = x.withColumn("results", F.filter("_rows", lambda r: (r["href"] != "") & ~r["href"].rlike(form.drop) & (r["href"].rlike(form.accept) if form.accept else F.lit(True)) & (F.length(r["title"]) >= form.least)))
    if form.once:
        x = x.withColumn("results", F.filter("results", lambda r, i: F.array_position(F.col("results.href"), r["href"]) == i + 1))
    return x.drop("_page", "_rows")


def unescaped_but_markup(html: Column) -> Column:
    """References as characters, but for those of signs that are markup and of the ampersand itself, which stay."""
    kept = F.regexp_replace(F.coalesce(html, F.lit("")), r"&(amp|lt|gt|quot|#39|#x27|#34|#60|#62|#38);", "\u0001$1\u0002")
    return F.regexp_replace(unescaped(kept), "\u0001([a-z0-9#]+)\u0002", "&$1;")
