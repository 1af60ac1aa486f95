import re

import duckdb
import pytest
from helpers import SMOKE
from kestrel.llm.html_text import attributes, extract, html_to_text

CASES = [
    (None, ""), ("", ""), ("plain  text\n here", "plain text here"),
    ("<p>one<p>two", "one\n\ntwo"),
    ("a<b>b</b> c<br>d", "ab c\nd"),
    ("<div>x</div><div>y</div>", "x\ny"),
    ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>e", "- a\n- b\n  3. c\n  4. d\n\ne"),
    ("<pre>\n a\n   b</pre>", " a\n   b"),
    ("<p hidden>no</p><p style='display: none'>no</p><i style='visibility:hidden'>no<u style='visibility:visible'>yes</u></i>",
     "yes"),
    ("<script>var a='</p><b>';</script><style>b{}</style><title>t</title>x<!-- c > -->y", "xy"),
    ("<table><tr><th>Name<th>Qty<tr><td>Apple pie<td>3</table>", "Name       Qty\nApple pie  3"),
    ("<table><tbody><td>a<td colspan=2>b<tr><td rowspan=2>c<td>d<td>e<tr><td>f<td>g</table>",
     "a  b\nc  d  e\n   f  g"),
    ("<table><tr><td>in<table><tr><td>ner<td>x</table></table>", "in\n\nner  x"),
    ("&lt;b&gt; &amp;&nbsp;&copy; &#65; 1 < 2 & 3", "<b> &\xa0© A 1 < 2 & 3"),
    ("<dl><dt>t<dd>d</dl>", "t\n    d"), ("<blockquote>q</blockquote>", "    q"),
    ("<details><summary>s</summary>no</details><details open><summary>s</summary>yes</details>", "s\ns\nyes"),
    ("</p>x</div></b><td>y", "xy"),  # a cell outside a table is no box of its own
    ("<p>cut <b", "cut"), ("<a title=\"x>y\">z</a>", "z"),
    ("<h1>a<h2>b</h2>c", "a\n\nb\n\nc"), ("<select><option>a<option>b</select>", "a\nb"),
]


@pytest.mark.parametrize("html,text", CASES)
def test_rendering(html, text):
    assert html_to_text(html) == text


def test_letters_that_grow_in_lower_case_before_raw_elements():
    assert html_to_text("<title>\u0130\u0130</title>a<script>x</SCRIPT>b") == "ab"
    assert html_to_text("<body><p>\u0130stanbul</p><script>var x='<p>';</script><p>seen</p>") == "\u0130stanbul\n\nseen"
    assert html_to_text("<script>a</\u017fcript>b</script>c") == "c"


def test_deep_nesting_and_long_rows():
    assert html_to_text("<div>" * 20_000 + "x") == "x"
    rows = "".join(f"<tr><td>{i}<td>{'v' * (i % 90)}" for i in range(500))
    assert len(html_to_text(f"<table>{rows}</table>").split("\n")) == 500
    assert html_to_text("<p x='" + "a" * 100_000) == ""


def test_pages_keep_every_visible_word(spark):
    rows = duckdb.connect().sql(f"SELECT page_id, html FROM '{SMOKE}/pages.parquet'").fetchall()
    got = {r.page_id: r.text for r in extract(spark.read.parquet(f"{SMOKE}/pages.parquet")).collect()}
    assert set(got) == {p for p, _ in rows}
    for p, html in rows:
        for block in re.findall(r"<p>([^<&]*)</p>", html):
            assert " ".join(block.split()) in got[p]
        assert "track(" not in got[p] and "margin:0" not in got[p]


def test_edge_cases(spark):
    df = spark.createDataFrame([(None, None, "x"), (1, "<p>a", "y"), (1, "<p>a", "y")], "page_id long, html string, text string")
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in extract(df).collect()) == [
        ("1", "a", 1), ("1", "a", 1), ("None", "", 0)]
    assert extract(df.limit(0)).count() == 0


def test_quotes_count_only_after_an_equals_sign():
    assert html_to_text("<p title=don't>Hello</p> <p>it's</p><p>end</p>") == "Hello\n\nit's\n\nend"
    assert html_to_text('<p a"b>one</p><p x= "a > b" y=\'>\'>two "quoted"</p>') == 'one\n\ntwo "quoted"'
    assert html_to_text("<p =x = y==z / hidden=no>gone</p><p title=>seen</p>") == "seen"
    assert attributes(""" a=1 B='x "y"' c="d'e" f g=h'i A=2 """) == {
        "a": "1", "b": 'x "y"', "c": "d'e", "f": "", "g": "h'i"}


def test_deep_nesting_is_linear():
    import time
    for tag in ("div", "ul", "p", "span"):
        t = time.time()
        assert html_to_text(f"<{tag}>" * 50_000 + "deep") == "deep"
        assert html_to_text("<p>open<table><tr><td>" + f"<{tag}>" * 50_000 + "deep").endswith("deep")
        assert time.time() - t < 10
