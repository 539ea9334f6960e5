"""Layout by cases, and all visible words of the test pages."""

import html as entities
import re

import pytest

from shoptide.llm.html_text import extract_text, visible_text
from shoptide.llm.queries import QUERIES

CASES = {
    "<p>a<p>b": "a\n\nb",
    "a<br>b<br/>c": "a\nb\nc",
    "x <b>bold</b>ly &amp; so &eacute;": "x boldly & so é",
    "<div>a</div><div>b</div>": "a\nb",
    "<ul><li>a<li>b<ul><li>c</ul></ul>d": "- a\n- b\n  - c\n\nd",
    "<ol start=3><li>a</li><li>b</li></ol>": "3. a\n4. b",
    "<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>": "a   | bb\nccc | d",
    "<table><td>a<td>b</table>": "a | b",
    "<table><tr><th>h<td>x<p>y</table>z": "h | x\n  | y\n\nz",
    "<pre>a\n  b\n\nc</pre>d": "a\n  b\n\nc\n\nd",
    "<head><title>t</title></head><body>b": "b",
    "<title>t</title><p>b": "b",
    "<head><p>b": "b",
    "<p hidden>a</p><p style='color:red; display: none'>b</p><p style='visibility:hidden'>c</p><p>d": "d",
    "<script>var t='</p>';</script><style>p{}</style><!-- no -->x<noscript>n</noscript>": "x",
    "<div hidden><div>a</div></div>b": "b",
    "<td>a</div></td>b</ul></x>": "a\nb",
    "<p>one\n  two\t three </p>": "one two three",
    "<h1>h</h1>t<blockquote>q</blockquote>": "h\n\nt\n\nq",
    "<dl><dt>a<dd>b<dt>c</dl>": "a\nb\nc",
    "<p>so <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><annotation>tex</annotation></math> holds": "so x = 1 2 holds",
    "<svg><title>t</title><defs><text>d</text></defs><rect/><desc/><text>one</text><text>two<tspan>s</tspan></text><style>s{}</style></svg>z": "one\ntwos\nz",
    "<textarea>\na  <b>\n b</textarea>c": "a  <b>\n b\nc",
    "<textarea>a &amp; b": "a & b",
    "in <select><option>a<option selected>b<option>c</select> now": "in b now",
    "<select><option disabled>a<optgroup label=g><option>b</select>": "b",
    "<select multiple><option>a<option>b</select>c": "a\nb\nc",
    "a<p>": "a",
    "<": "<",
    "": "",
}


@pytest.mark.parametrize("html", CASES)
def test_layout(html):
    assert visible_text(html) == CASES[html]


def plain_words(html):
    html = re.sub(r"(?s)<!--.*?-->|<head>.*?</head>|<script>.*?</script>|<style>.*?</style>", "", html)
    html = re.sub(r"</?(?:b|i|a|em|strong|span|u|code|small)\b[^>]*>", "", html)
    return entities.unescape(re.sub(r"<[^>]+>", " ", html)).split()


def test_query_has_all_visible_words(spark, folder, read):
    found = {r.page_id: r.text for r in QUERIES["op5_html_text"](spark, folder).collect()}
    pages = {r.page_id: r.html for r in read("pages").collect()}
    assert found.keys() == pages.keys()
    marks = re.compile(r"(?m)^\s*(?:- |\d+\. )| \| |\|")
    for i, html in pages.items():
        assert marks.sub(" ", found[i]).split() == [w for w in marks.sub(" ", " ".join(plain_words(html))).split()]


def test_edges(spark):
    deep = "<div>" * 20_000 + "x"
    wide = "<table>" + "<tr><td>" + "w" * 100_000 + "<td>b<tr><td>a<td>b" + "</table>"
    pages = spark.createDataFrame([(1, None, "own"), (2, "", "own"), (2, "", "own"), (None, deep, "own"), (3, wide, "own")], "page_id long, html string, text string")
    rows = {(r.page_id, len(r.html or "")): r.text for r in extract_text(pages).collect()}
    assert rows[1, 0] == rows[2, 0] == "" and rows[None, len(deep)] == "x"
    assert rows[3, len(wide)] == "w" * 100_000 + " | b\n" + "a".ljust(40) + " | b"
    assert extract_text(pages.limit(0)).count() == 0
    assert extract_text(pages).columns == ["page_id", "html", "text"]


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ('<ol start="--5"><li>a</ol>', "1. a"),
        (f'<ol start="{"9" * 5000}"><li>a</ol>', "1. a"),
        ('<ol start=" -3"><li>a<li>b</ol>', "-3. a\n-2. b"),
        (f'<select size="{"9" * 5000}"><option>a<option>b</select>', "a"),
        ("<![foo[x]]>y", "y"),
        ("a<![CDATA[x]]>b<![", "ab<!["),
        ("<table><tr><td colspan=2>ab<td>c<tr><td>1<td>2<td>3</table>", "ab    | c\n1 | 2 | 3"),
        ("<table><tr><td rowspan=2>ab<td>c<tr><td>1<tr><td>x<td>y</table>", "ab | c\n   | 1\nx  | y"),
        ("<table><tr><td rowspan=0>a<td colspan=5000>b<tr><td>c</table>", "a | b\n  | c"),
        ("<table><tr><td>" + "ab " * 20 + "<td>x<tr><td>s<td>y</table>", ("ab " * 13).strip().ljust(38) + " | x\n" + ("ab " * 7).strip().ljust(38) + " |\n" + "s".ljust(38) + " | y"),
        ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"),
        ('<div style="visibility:hidden">a<p style="visibility: visible">b</p>c</div>', "b"),
        ('<div hidden>a<p style="visibility:visible">b</p></div>c', "c"),
    ],
)
def test_odd_markup(html, text):
    assert visible_text(html) == text
