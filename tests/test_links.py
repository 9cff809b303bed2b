from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.urls import resolved, unescaped
from tallyloom.operators.links import resolved_links

PAGE = """<!-- <a href="/commented">x</a> --><script>var s = '<a href="/scripted">';</script>
<A HREF=/unquoted class=x>u</A> <a data-href="/no" href='single.pdf'>s</a> <a title="a > b" href="quoted?a=1&amp;b=2#f">q</a>
<a name="here">none</a> <abbr href="/no">n</abbr> <a href>empty</a> <a href = " /spaced ">s</a>
<a title=' href="/inside" ' href="//other.org/p">o</a> <a href="mailto:a@b.co">m</a> <a href="../up/./x/../&#x79;&#233;.pdf">d</a>
<a href="/twice" href="/second">t</a> <style>a { content: '<a href="/styled">' }</style><a href="last/">l</a>
<!-- never closed <a href="/lost">"""
EXPECTED = [
    "http://h.org/unquoted",
    "http://h.org/docs/single.pdf",
    "http://h.org/docs/quoted?a=1&b=2#f",
    "http://h.org/docs/page.html",
    "http://h.org/spaced",
    "http://other.org/p",
    "mailto:a@b.co",
    "http://h.org/up/yé.pdf",
    "http://h.org/twice",
    "http://h.org/docs/last/",
]


def links(df, part=None):
    return [r.link for r in resolved_links(df, "id", "html", "url", part).orderBy("id", "place").collect()]


def test_what_a_pattern_gets_wrong(frame):
    df = frame([(1, PAGE, "http://h.org/docs/page.html")], "id int, html string, url string")
    assert links(df) == EXPECTED
    assert links(df, ".pdf") == [x for x in EXPECTED if ".pdf" in x]


def test_base_element(frame):
    page = '<a href="x">1</a><base href="/b/c?q"><base href="/later/"><a href="../y">2</a>'
    df = frame([(1, page, "https://h.org/a/"), (2, page, None), (3, None, "http://h.org"), (4, "", "http://h.org")],
               "id int, html string, url string")
    assert links(df) == ["https://h.org/b/x", "https://h.org/y", None, None]


def test_long_pages_cost_no_stack(frame):
    page = "<a title='" + "x" * 300_000 + "' href=/a>" + "<p a=b 'c' \"d\">" * 40_000 + "<!--" + "y" * 300_000 + "--><a href=/b>"
    df = frame([(1, page, "http://h.org/")], "id int, html string, url string")
    assert links(df) == ["http://h.org/a", "http://h.org/b"]


REFERENCES = ["g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "", ".", "./", "..", "../", "../g",
              "../..", "../../", "../../g", "../../../g", "/./g", "/../g", "g.", ".g", "g..", "..g", "./../g",
              "g/./h", "g/../h", "http://x.org/a/../b", "g?y/../x", "g#s/./x"]


@pytest.mark.parametrize("base", ["http://a/b/c/d?q", "http://a", "http://a/", "http://a/b/c/"])
def test_references(frame, base):
    df = frame([(i, r) for i, r in enumerate(REFERENCES)], "i int, r string")
    got = [x[0] for x in df.orderBy("i").select(resolved(F.lit(base), F.col("r"))).collect()]
    skip = {"http://x.org/a/../b"}  # the standard library leaves dots of absolute references
    for r, link in zip(REFERENCES, got):
        assert link == ("http://x.org/b" if r in skip else urljoin(base, r)), (base, r)


def test_entities(frame):
    cells = ["a&amp;b", "&#65;&#x1D11E;", "&copy;&", "&#xD800;", "&#0;", "&#1114112;", "", None, "&amp;lt;"]
    df = frame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    got = [x[0] for x in df.orderBy("i").select(unescaped(F.col("c"))).collect()]
    assert got == ["a&b", "A\U0001d11e", "&copy;&", "&#xD800;", "&#0;", "&#1114112;", "", None, "&lt;"]
