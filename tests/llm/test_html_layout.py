import pytest

from orderlens.llm import html_layout as hl

CASES = {
    "inline and spaces": ("<p>a  <b>b</b>\n c<i>d</i></p>", "a b cd"),
    "implied paragraph ends": ("<p>one<p>two<div>three</div>four", "one\n\ntwo\n\nthree\nfour"),
    "heading and text": ("<h1>T</h1>text<h2>U</h2>", "T\n\ntext\n\nU"),
    "break": ("a<br>b<br/>c", "a\nb\nc"),
    "two breaks": ("a<br><br>b", "a\n\nb"),
    "lists": ("<ul><li>a<li>b<ul><li>c</ul></ul><ol start=3><li>x<li value=9>y<li>z</ol>", "- a\n- b\n  - c\n\n3. x\n9. y\n10. z"),
    "table": ("<table><tr><th>Name<th>N<tr><td>long cell<td>1<tr><td>x<td>22</table>", "Name       N\nlong cell  1\nx          22"),
    "colspan": ("<table><tr><td>a<td>b<td>c</tr><tr><td colspan=2>wide<td>d</table>", "a  b  c\nwide  d"),
    "caption and sections": ("<table><caption>C</caption><thead><tr><td>h<tbody><tr><td>v</table>", "C\nh\nv"),
    "stray text in a table is kept": ("<table>x<tr><td>y</table>", "x\ny"),
    "cell outside a row": ("<table><td>a<td>b</table>", "a  b"),
    "nested table": ("<table><tr><td><table><tr><td>in</table><td>out</table>", "in  out"),
    "hidden": ("<div hidden>n</div><div style='color:red; DISPLAY : none'>n</div><p style=visibility:hidden>n<b style='visibility:visible'>y</b>", "y"),
    "invisible elements": ("<head><title>n</title></head><body><script>var a='</p>';</script><style>p{}</style><noscript>n</noscript>y", "y"),
    "head ends by content": ("<head><meta x><p>y", "y"),
    "raw text ends at its tag": ("<script>if (a</b) {'<p>'}</script>y", "y"),
    "pre": ("<pre>  a\n   b</pre>", "  a\n   b"),
    "entities": ("&copy;&amp;lt;&nbsp;x&#228;&am", "©&lt;\xa0xä&am"),
    "comments": ("a<!-- <p>b --><!DOCTYPE x><?php x ?>c<!-- open", "ac"),
    "details": ("<details><summary>s</summary>n</details><details open><summary>t</summary>y</details>", "s\nt\ny"),
    "definition list": ("<dl><dt>T<dd>D<dt>U<dd>E</dl>", "T\n  D\nU\n  E"),
    "quote": ("a<blockquote>q</blockquote>b", "a\n\n  q\n\nb"),
    "stray ends": ("</b></table>a</p>b", "a\n\nb"),
    "no tags": ("1 < 2 > 0", "1 < 2 > 0"),
    "quoted gt": ("<a title='x > y'>t</a>", "t"),
    "nothing": ("", ""),
}
SHOWN = {
    "formula": ("<p>so <math><semantics><mrow><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></mrow><annotation>n</annotation></semantics></math> holds", "so x= 1 2 holds"),
    "drawing": (
        "a<svg><title>n</title><defs><text>n</text></defs><style>n</style>n<g>n<text>T<tspan>U</tspan></text><text>V &amp; <![CDATA[w>x]]></text></g></svg>b",
        "a TU V & w>x b",
    ),
    "html in a drawing": ("<svg><foreignObject><div>one</div><div/>two</foreignObject><text display=none>n</text><text visibility='hidden'>n</text></svg>", "one\ntwo"),
    "image map": ("<map name=m><a href=x>here</a><area alt=n></map>", "here"),
    "choices": ("Pick <select><option>a<option selected>b<optgroup label=G><option label=c>n<option>d</select> now", "Pick\na\nb\nG\nc\nd\nnow"),
    "datalist": ("<datalist><option>n</datalist>y", "y"),
    "drawing that ends itself": ("<p><svg class=\"i\"/> Hello</p>", "Hello"),
    "drawing that ends itself in body": ("<body><svg viewBox='0 0 1 1' /><p>one</p><math/><p>two", "one\n\ntwo"),
    "elements that end themselves": ("<svg><path d='x=y'/><title/><style/><g/><text>T</text></svg>y", "T y"),
    "slash in an unquoted value": ("<svg class=i/>n</svg>y", "y"),
    "drawing that is never closed": ("<div><svg><g><p>one</p><svg><path></div>two", "one\n\ntwo"),
    "slash outside a drawing": ("<div hidden/>n</div>y", "y"),
}


@pytest.mark.parametrize("name", CASES)
def test_layout(name):
    html, want = CASES[name]
    assert hl.render(html) == want


TABLES = {
    "rowspan": ("<table><tr><th>A<th>B<th>C<tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e<tr><td>f<td>g</table>", "A  B  C\na  b  c\n   d  e\nf  g"),
    "rowspan and colspan": ("<table><tr><td>a<td rowspan=3 colspan=2>bb<td>c<tr><td>d<td>e<tr><td>f<td>g</table>", "a  bb  c\nd      e\nf      g"),
    "rowspan to the end of its section": ("<table><tbody><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d<tbody><tr><td>e<td>f</table>", "a  b\n   c\n   d\ne  f"),
    "colspan widens": ("<table><tr><td colspan=2>wide cell<td>d<tr><td>a<td>b<td>c</table>", "wide cell  d\na  b       c"),
    "hidden cell": ("<table><tr><td style='visibility:hidden'>n<b style='visibility:visible'>y</b><td>b<tr><th style='visibility:hidden'>nnn<td>c</table>", "y  b\n   c"),
    "hidden row and section": (
        "<table><tbody style='visibility:hidden'><tr><td>n<tr style='visibility:visible'><td>y<tbody><tr style='visibility:collapse'><td>n<td style='visibility:visible'>z</table>",
        "y\n   z",
    ),
    "visible row of a hidden table": ("<table style='visibility:hidden'><tr><td>n<tr style='visibility:visible'><td>a<td>b</table>", "a  b"),
}


@pytest.mark.parametrize("name", TABLES)
def test_tables(name):
    html, want = TABLES[name]
    assert hl.render(html) == want


@pytest.mark.parametrize("depth", [10, 190, 300, 20_000])
def test_depth_keeps_structure_and_visibility(depth):
    deep = "<div>" * depth
    assert hl.render(deep + "<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>ee<td>f</table>") == "- a\n- b\n\nc   d\nee  f"
    assert hl.render(f"{deep}<p hidden>n<span>n</span></p><div style='visibility:hidden'>n{deep}n{'</div>' * (depth + 1)}y") == "y"
    assert hl.render("<blockquote>" * depth + "<div hidden>n<p>n<ul><li>n</ul></div><ul><li>y").split() in (["-", "y"], ["y"])


@pytest.mark.parametrize("name", SHOWN)
def test_text_that_browsers_show(name):
    html, want = SHOWN[name]
    assert hl.render(html) == want


@pytest.mark.parametrize(
    "html", ["<" * 3000, "<div>" * 30_000 + "deep", "<table><tr><td>" * 2000 + "deep", "<a \"" * 2000, "<ul><li>" * 2000 + "deep", "<!--" * 3000, "x " * 500_000]
)
def test_hostile_and_long_pages(html):
    text = hl.render(html)
    assert ("deep" in text) == ("deep" in html)


def test_every_visible_word_of_the_pages_is_kept(spark, sf):
    """Against a plain tag stripper: the same words, in the same order."""
    import re
    from html import unescape

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    for r in hl.extract(pages).select("html", "text").collect():
        bare = re.sub(r"<head.*?</head>|<script.*?</script>|<style.*?</style>|<!--.*?-->", "", r.html, flags=re.S)
        bare = unescape(re.sub(r"</?(?:b|i|a|em|strong|span)\b[^>]*>", "", bare).replace("<", " <").replace(">", "> "))
        bare = re.sub(r" <[^>]*(?:> |\Z)", " ", bare)
        got = [w for w in r.text.split() if w != "-"]
        assert got == [w for w in bare.split() if w != "-"]


def test_frame(spark, frame):
    df = frame([(1, "<p>a", "mine"), (1, "<p>a", "mine"), (None, None, None)], "page_id long, html string, text string")
    got = sorted((str(r.page_id), str(r.text)) for r in hl.extract(df).collect())
    assert got == [("1", "a"), ("1", "a"), ("None", "None")]
    assert hl.extract(spark.createDataFrame([], "page_id long, html string")).collect() == []
