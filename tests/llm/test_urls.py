from pyspark.sql import functions as F

from trawl.llm import q_urls, urls


def test_rules_and_parts(spark):
    cases = [
        (1, "http://WWW.Example.com/en/1?x#y", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        (2, "https://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
        (3, "https://example.com/de/", "example.com", "/de/", "com/", "allow"),
        (4, "https://example.com", "example.com", "", None, "allow"),
        (5, "http://x.net/es/1", "x.net", "/es/1", "net/es/", "block"),
        (6, "http://x.net/fr/", "x.net", "/fr/", "net/fr/", "block"),
        (7, None, "", "", None, "allow"),
        (8, "no scheme", "", "", None, "allow"),
        (9, "http://notexample.com?q", "notexample.com", "", None, "allow"),
        (10, "http://h.org#f", "h.org", "", None, "allow"),
    ]
    bad = [(100 + i, f"http://spam.bad.org/{i}", "spam.bad.org", f"/{i}", None, "block") for i in range(60)]
    good = [(300 + i, f"http://fine.good.org/{i}", "fine.good.org", f"/{i}", None, "allow") for i in range(60)]
    html = lambda i: "%%%$$$ text" if 100 <= i < 200 else None if i == 9 else "<p>good text without signs, long enough that it isn't taken for an empty page</p>"
    rows = [*cases, *bad, *good, bad[0]]
    df = spark.createDataFrame([(r[0], r[1], html(r[0]), "x", 1) for r in rows], "page_id long, url string, html string, host string, n int")
    got = [(r.page_id, r.url, r.judged.host, r.judged.path, r.judged.rule, r.judged.verdict) for r in urls.judge(df).collect()]
    assert sorted(got) == sorted(rows)
    assert urls.judge(df.limit(0)).count() == 0


def test_signs(spark):
    long_ = "<p>" + "plain words " * 20 + "</p>"
    cases = [(1, "http://a.org/x", long_, 0), (2, "http://a.org/x", None, None), (3, "http://a.org/x", "<p>short</p>", 1), (4, "http://m.casino-win.org/", long_, 0), (5, "http://a.org/Best-Bets/", long_, 1), (6, "http://alphabets.org/", long_, 0), (7, "http://a.org", long_ + "<a href=x>l</a>" * 20, 1), (8, "http://a.org", long_ * 20_000 + "%", 0), (9, None, "%" * 100, 1)]
    df = spark.createDataFrame(cases, "page_id long, url string, html string, want int")
    for r in df.select("page_id", "want", urls.bad_page(F.col("url"), F.col("html")).alias("got")).collect():
        assert r.got == r.want, r


def test_suffixes(spark):
    cases = [("www.a.co.uk", "co.uk", "a.co.uk"), ("a.b.com", "com", "b.com"), ("x.y.com.pl:80", "com.pl", "y.com.pl"), ("uk", "uk", "uk"), ("co.uk", "co.uk", "co.uk"), ("1.2.3.4", "4", "1.2.3.4"), ("b.paris.fr", "fr", "paris.fr"), ("", "", "")]
    df = spark.createDataFrame(cases, "host string, suffix string, domain string")
    for r in df.select("*", urls.suffix_of(F.col("host")).alias("s"), urls.domain_of(F.col("host")).alias("d")).collect():
        assert (r.s, r.d) == (r.suffix, r.domain), r


def test_bad_hosts_are_blocked_by_the_corpus_own_rate(spark):
    """Three of sixty hosts are bad, one of them with four pages; a good host that has one bad page among thirty stays, labels or signs."""
    rows = [(f"http://h{h}.org/{i}", int(h < 3 or (h == 9 and i == 0)), "x", "y", "z") for h in range(60) for i in range(4 if h == 2 else 30)]
    df = spark.createDataFrame(rows, "url string, bad int, host string, judged_ string, _host string")
    got = urls.judge(df, html="url", rules=(), outcome="bad").select("url", "judged.verdict", "host", "_host").collect()
    assert {r.url.split("/")[2] for r in got if r.verdict == "block"} == {"h0.org", "h1.org", "h2.org"} and len(got) == len(rows)
    assert {(r.host, r._host) for r in got} == {("x", "z")}


def test_pages_decide_not_names(spark):
    """A host with a listed word and good pages stays; an innocent name with bad pages is blocked."""
    good, bad = "<p>" + "plain words " * 20 + "</p>", "<p>" + "%%$$ words " * 20 + "</p>"
    rows = [(f"http://{h}/{i}", bad if h == "quiet.garden.org" else good) for h in ("casino.xxx-spam.org", "quiet.garden.org", *[f"h{k}.org" for k in range(40)]) for i in range(30)]
    got = urls.judge(spark.createDataFrame(rows, "url string, html string"), rules=()).select("judged.host", "judged.verdict").distinct().collect()
    assert {r.host for r in got if r.verdict == "block"} == {"quiet.garden.org"} and len(got) == 42


def test_long_urls_and_pages(spark):
    rows = [("http://h.org/" + "a" * 100_000 + "?" + "q" * 100_000, "<p>" + "word " * 200_000), ("http://" + "h" * 2_000 + ".org", "x" * 300_000)]
    got = urls.judge(spark.createDataFrame(rows, "url string, html string")).select("judged.*").collect()
    assert sorted(len(r.path) for r in got) == [0, 100_001] and {r.verdict for r in got} == {"allow"}


def test_query_columns(spark, tmp_path):
    spark.createDataFrame([(1, "http://a.co.uk:80/x", "t", "u", "v")], "page_id long, url string, html string, verdict string, host string").write.parquet(f"{tmp_path}/pages.parquet")
    got = q_urls.op10_url_reputation(spark, str(tmp_path))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"] and got.count() == 1
