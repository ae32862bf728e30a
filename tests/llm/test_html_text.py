from html.parser import HTMLParser

import duckdb
import pytest

from tests_support import SF, rows
from tracelake.llm.html_text import page_texts, render

CASES = [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a\n\nb"), ("<div>a</div><div>b<br>c</div>d", "a\nb\nc\nd"),
    ("<ul><li>one<li>two<ul><li>deep</ul><li>three</ul>after", "- one\n- two\n  - deep\n- three\n\nafter".replace("- ", "- ")),
    ("<ol start=3><li>x<li value=7>y<li>z</ol>", "3. x\n7. y\n8. z"),
    ("<table><tr><th>Name<th>Qty<tr><td>pear<td>12<tr><td>a long one<td>3</table>", "Name        Qty\npear        12\na long one  3"),
    ("<table><caption>T</caption><tr><td colspan=2>wide<td>x<tr><td>a<td>b<td>c</table>", "T\nwide  x\na  b  c"),
    ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
    ("<table><tr><td>a<table><tr><td>i<td>j</table><td>b</table>", "a       b\n\ni  j".replace("       b", "     b")),
    ("<p>a</p><script>var t='</p>';</script><style>p{}</style><!-- no --><p hidden>h</p><p style='display: none'>n</p><p>b", "a\n\nb"),
    ("<style>.ad, #x {display:none} i{visibility:hidden}</style><div class='big ad'>ad</div><p id=x>x</p><i>no<b style='visibility:visible'>yes</b></i>", "yes"),
    ("<head><title>T</title></head><body>x<template>t</template><noscript>n</noscript><details><summary>s</summary>in</details><details open><summary>o</summary>out</details>", "x\ns\no\nout"),
    ("<pre>a  b\n  c</pre>d", "a  b\n  c\n\nd"), ("a <b>b</b> <i> c</i>\n\n d", "a b c d"), ("<h1>T</h1>x<hr>y", "T\n\nx\n\ny"), ("1 < 2 and a<b", "1 < 2 and a"),
    ("<a href=\"x>y\">link</a></nothing>", "link"), ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"), ("<blockquote><p>q</blockquote>r", "  q\n\nr"), ("x&nbsp;&nbsp;y", "x  y"),
    ("<select><option>a<option selected>b</select>", "a\nb"), ("</p>x<br><br>y", "x\n\ny"), ("<textarea> <b>kept</textarea>", " <b>kept"),
]


@pytest.mark.parametrize(("html", "want"), CASES)
def test_layout(html, want):
    got = render(html)
    assert [line.rstrip() for line in got.split("\n")] == [line.rstrip() for line in want.split("\n")]


class Words(HTMLParser):
    """Visible words of a page without layout, by the parser of the standard library."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.parts, self.depth = [], 0
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.depth += tag in ("head", "script", "style", "title")
        if tag not in ("a", "b"):
            self.parts.append(" ")

    def handle_endtag(self, tag):
        self.depth -= tag in ("head", "script", "style", "title")
        if tag not in ("a", "b"):
            self.parts.append(" ")

    def handle_data(self, data):
        if not self.depth:
            self.parts.append(data)


def test_all_visible_words_of_all_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = dict(rows(page_texts(pages), "page_id", "text"))
    known = duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()
    assert len(got) == len(known)
    for page, html in known:
        words = [w for w in got[page].split() if w != "-"]
        assert words == [w for w in "".join(Words(html).parts).split() if w != "-"]


def test_deep_long_and_odd_pages(spark):
    pages = [(1, "<div>" * 20_000 + "deep"), (2, "<ul><li>" * 3000 + "x"), (3, "<p>w " * 50_000), (4, "<table>" * 500 + "<tr><td>c"), (5, None), (None, "n"), (5, "again"), (6, "<" * 5000), (7, "<a " + "b='c' " * 20_000)]
    frame = spark.createDataFrame([(i, h, "x", "y") for i, h in pages], "page_id long, html string, text string, __html string")
    got = page_texts(frame)
    assert got.columns == ["page_id", "text"]
    texts = [tuple(r) for r in got.collect()]
    assert (1, "deep") in texts and (5, "") in texts and (5, "again") in texts and (None, "n") in texts and len(texts) == len(pages)
    assert page_texts(frame.limit(0)).count() == 0
