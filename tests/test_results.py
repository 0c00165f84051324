"""Result rows of five page forms."""

from trawl.functions.results import FORMS, result_rows

PAGES = {
    "so360": '<h3 class="x res-title y"><a href="http://a.org/1" t="1">One <em>two</em>&nbsp;</a></h3><h3 class="other"><a href="http://b.org">no</a></h3><h3 class="res-title"><a href="javascript:;">js</a></h3>',
    "sogou": '<h3 class="vr">\n <a id="1" href="/link?url=z">Caf&eacute;\n x</a></h3><h3><a href="http://c.org?a=1&amp;b=2">two</a></h3>',
    "bing": '<h2 class="t"><a target="_blank" href="https://d.org">D</a></h2><h2><a href="/rel">no</a></h2>',
    "brave": '<a class="l" href="https://e.org">title of e</a><a href="https://e.org">again, e</a><a href="https://search.brave.com/x">own host</a><a href="http://f.org">abc</a><a href="/x">relative</a>',
    "weixin": '<ul><li><h3><a href="/link?url=1&amp;k=2">First</a></h3><p class="txt-info" id="s">dig <b>est</b></p><a class="account" href="#">Acc</a><script>document.write(timeConvert(\'1700000000\'))</script></li><li><h3> <a href="/link?url=2">Second</a> </h3></li></ul>',
}
WANT = {
    "so360": [("http://a.org/1", "One two", None, None, None)],
    "sogou": [("https://www.sogou.com/link?url=z", "Café x", None, None, None), ("http://c.org?a=1&b=2", "two", None, None, None)],
    "bing": [("https://d.org", "D", None, None, None)],
    "brave": [("https://e.org", "title of e", None, None, None)],
    "weixin": [("/link?url=1&k=2", "First", "Acc", 1700000000, "dig est"), ("/link?url=2", "Second", None, None, None)],
}


def test_forms(spark):
    for name, page in PAGES.items():
        got = result_rows(spark.createDataFrame([(page,), (None,), ("",)], "html string").coalesce(1), FORMS[name]).collect()
        assert [tuple(r) for r in got[0].results] == WANT[name], name
        assert got[1].results == got[2].results == []
