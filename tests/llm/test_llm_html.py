import pytest

from tramline.llm import html_text
from tramline.llm.html_text import build, render

CASES = {
    "plain": ("just text &amp; more", "just text & more"),
    "paragraphs": ("<p>one<p>two</p>three", "one\n\ntwo\n\nthree"),
    "inline": ("<p>a <b>bold <i>x</b> y</i>  z</p>", "a bold x y z"),
    "unclosed": ("<p><b>a<br><p>b</p><p>c", "a\n\nb\n\nc"),
    "blocks": ("<div>a<div>b</div>c</div><div>d</div>", "a\nb\nc\nd"),
    "break": ("a<br>b<br/><br>c</br>d", "a\nb\n\nc\nd"),
    "head": ("<html><head><title>T</title><style>p{}</style>seen<p>x", "seen\n\nx"),
    "raw": ("a<script>var t='</p><b>';</script>b<style>x</style>c<!-- d > e -->f", "abcf"),
    "noscript": ("a<noscript><p>no</p></noscript>b", "ab"),
    "hidden": (
        "<p hidden>x</p><p style='color:red;display : none'>y</p><p style=\"visibility:hidden\">z</p><p>seen</p>",
        "seen",
    ),
    "details": ("<details><summary>s</summary>more</details><details open><summary>t</summary>u</details>", "s\nt\nu"),
    "list": ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    "numbers": ("<ol start=9><li>a</li><li>b<p>c</p></li></ol>", "9. a\n10. b\n\n    c"),
    "definitions": ("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "a\n  b\nc\n  d"),
    "quote": ("a<blockquote>b<p>c</blockquote>d", "a\n\n  b\n\n  c\n\nd"),
    "pre": ("<pre>\n a  b\n\n   c</pre>x", " a  b\n\n   c\n\nx"),
    "table": (
        "<table><tr><th>name<th>n<tr><td>long name<td>1<tr><td>b<td>22</table>after",
        "name       n\nlong name  1\nb          22\n\nafter",
    ),
    "spans": (
        "<table><tr><td rowspan=2>a<td colspan=2>b<td>z<tr><td>c<td>d<td>e</table>",
        "a  b     z\n   c  d  e",
    ),
    "cell lines": ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
    "nested table": ("<table><tr><td><table><tr><td>x<td>y</table><td>z</table>", "x  y  z"),
    "table parts": ("<table><caption>cap</caption><thead><tr><td>h<tbody><tr><td>b</table>", "cap\nh\nb"),
    "quotes in tags": ("<a title='a>b' href=x>c</a><a title=\"d>\">e</a>", "ce"),
    "broken tags": ("a < b <3 c <p", "a < b <3 c"),
    "open quote": ("<p title='x>seen</p>", "seen"),
    "case": ("<P>A</P><SCRIPT>x</SCRIPT>B<Br>C", "A\n\nB\nC"),
    "entities": ("&lt;p&gt; &eacute;&#233;&#xe9; &nbsp;x", "<p> ééé  x"),
    "stray ends": ("</p></div>a</td></b>b</ul>", "ab"),
    "empty": ("", ""),
    "only markup": ("<html><body><div></div></body></html>", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_layout(name):
    page, want = CASES[name]
    assert render(build(page)) == want


def test_deep_and_long_pages():
    assert render(build("<div>" * 20_000 + "x")) == "x"
    assert render(build("<ul><li>" * 300 + "x")).endswith("- x")
    assert len(render(build("<p>word " * 20_000)).split()) == 20_000
    assert render(build("<p title='" * 3000 + "x")) is not None


def test_a_wide_cell_does_not_widen_its_column():
    wide = "x" * 500
    lines = render(build(f"<table><tr><td>{wide}<td>1<tr><td>a<td>2</table>")).split("\n")
    assert lines == [f"{wide}  1", "a  2"]


def test_pages(spark):
    rows = [(1, "<title> A  &amp; B</title><p>x", "u"), (2, None, "u"), (2, "", "u"), (None, "y", "u")]
    df = spark.createDataFrame(rows, "page_id long, html string, title string")
    got = sorted((tuple(r) for r in html_text.extract_text(df).collect()), key=str)
    assert got == sorted([(1, "A & B", "x", 1), (2, None, "", 0), (2, None, "", 0), (None, None, "y", 1)], key=str)
    assert html_text.extract_text(df.where("page_id = 9")).collect() == []
