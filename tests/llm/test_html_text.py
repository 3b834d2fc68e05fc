import html.parser
import re
import time

import pytest

from govframe.llm import html_text as H

CASES = {
    "<p>One<p>Two &amp; <b>three</b>\n four<br>five<ul><li>a<li>b<ul><li>c</ul><li>d</ul>tail": "One\n\nTwo & three four\nfive\n\n- a\n- b\n  - c\n- d\n\ntail",
    "<table><tr><th>Name<th>Qty<tr><td>apple pie<td>3<tr><td rowspan=2>x<br>y<td>12<tr><td>z</table>after": "Name       Qty\napple pie  3\nx          12\ny\n           z\n\nafter",
    "<div hidden>no</div><span style='display: none'>no</span><div style='visibility:hidden'>no<b style='visibility:visible'>yes</b></div><script>var a='</p>';</script>end": "yes\nend",
    "<pre> a\n  b</pre>": " a\n  b",
    "<ol start=3><li>x<li value=9>y<li>z</ol>": "3. x\n9. y\n10. z",
    "<dl><dt>t<dd>d<dt>u</dl>": "t\n  d\nu",
    "a<table><td>c</table>b": "a\n\nc\n\nb",
    "<ul><li></li><li><p>q</p><p>r</p></li></ul>": "-\n\n- q\n\n  r",
    "<div>a</div><div>b</div> c  d <i> e</i>": "a\nb\nc d e",
    "<details><summary>s</summary>hid</details><details open><summary>t</summary>u</details>": "s\nt\nu",
    "x < y & z <3": "x < y & z <3",
    "<p>a</p></p>b": "a\n\nb",
    '<a href="x>y">k</a><a title=it\'s>m</a>': "km",
    "<!-- c --><!--> <p>v<!-- open": "v",
    "<title>t</title><body>x<noscript>n</noscript><template>t</template>": "x",
    "<table><tr><td colspan=2>wide<tr><td>a<td>bb<tr><td>ccc<td>d</table>": "wide\na    bb\nccc  d",
    "<SCRIPT>x</scRIPT >y<style>z": "y",
    "1<br><br>2": "1\n\n2",
    "&lt;b&gt; &eacute;&#x41;&nbsp;.": "<b> éA\xa0.",
    "<b>un<i>closed</b> text</i> end": "unclosed text end",
}


@pytest.mark.parametrize("source", CASES)
def test_rendering(source):
    assert H.page_text(source)[0] == CASES[source]


def test_counts():
    text, lines, tables, items = H.page_text("<ul><li>a<li>b</ul><table><td>1</table><table hidden><td>2</table>")
    assert (lines, tables, items) == (3, 1, 2)


def test_no_input_is_too_deep_or_too_broken():
    began = time.time()
    assert H.page_text("<div>" * 50_000 + "x")[0] == "x"
    assert H.page_text("<ul><li>a" * 5_000)[0].count("a") == 5_000
    assert H.page_text("<table><tr><td>" * 3_000 + "x")[0].strip() == "x"
    for bad in ("<a ", "<p>", "<b>x</i>", "<!--", "<a b='", "</", "<", "<table><tr><td><p>", "&", "<a b=", "<li><dd>", "</p>"):
        H.page_text(bad * 10_000)
    assert H.page_text("<table>" + "<tr><td colspan=99999999>x<td rowspan=99999999>y" * 500 + "</table>")[0].count("y") == 500
    assert time.time() - began < 60


def test_all_visible_words_come_out_in_order():
    """Random nested pages: the words outside hidden elements appear once each, in order."""
    import random

    rng = random.Random(5)
    for _ in range(200):
        words, counter = [], [0]

        def build(depth, hidden, words=words, counter=counter):
            out = []
            for _ in range(rng.randint(1, 4)):
                if depth > 4 or rng.random() < 0.4:
                    counter[0] += 1
                    w = f"w{counter[0]}e"
                    out.append(f" {w} ")
                    if not hidden:
                        words.append(w)
                else:
                    tag = rng.choice(["div", "p", "span", "b", "section", "blockquote", "h2", "pre", "article"])
                    hide = rng.random() < 0.15
                    out.append(f"<{tag}{' hidden' if hide else ''}>{build(depth + 1, hidden or hide)}</{tag}>" if tag not in ("p", "h2") else f"<{tag}>{build(9, hidden)}</{tag}>")
            return "".join(out)

        page = build(0, False)
        assert H.page_text(page)[0].split() == words


def test_table_nulls_empty_and_repeats(spark):
    rows = [(1, None, "z"), (2, "", "z"), (2, "<p>a", "z"), (2, "<p>a", "z"), (None, "plain", "z")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string").repartition(2)
    got = sorted(((-1 if r.page_id is None else r.page_id), r.text) for r in H.extract_text(df).collect())
    assert got == [(-1, "plain"), (1, ""), (2, ""), (2, "a"), (2, "a")]
    assert H.extract_text(df.limit(0)).collect() == []


def test_query_covers_all_pages(spark):
    from govframe.llm.queries import op3_html_text

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "html").collect()
    got = {r.page_id: (r.text, r.n_chars) for r in op3_html_text(spark, "/root/testdata/sf0.001").collect()}
    assert got == {p.page_id: (t := H.page_text(p.html)[0], len(t)) for p in pages}
    assert not any("track(" in t or "<p>" in t for t, _ in got.values())


FOREIGN_AND_HEAD = {
    # MathML and SVG text are seen; their titles, definitions and annotations are not
    "let <math><mi>x</mi><mo>+</mo><mn>1</mn></math> be": "let x+1 be",
    "<math><semantics><mi>y</mi><annotation encoding='application/x-tex'>\\tex</annotation><annotation-xml>no</annotation-xml></semantics></math>": "y",
    "a<svg>no<title>no</title><desc>no</desc><defs><text>no</text></defs><metadata>no</metadata><g>no<text>see <tspan>me</tspan></text></g></svg>b": "a\nsee me\nb",
    "<svg><text>one</text><text>two</text></svg>": "one\ntwo",
    "<svg><style>.a > .b {}</style><text style='display:none'>no</text><text>A &amp; B</text></svg>": "A & B",
    "<svg><title/><defs/><rect width=5 /><text>seen</text></svg>": "seen",
    "<svg><g id=a/><text>in</text></g></svg>out": "in\nout",
    "<svg><defs><p>out of it</p>end": "out of it\n\nend",
    "<p>a<svg><foreignObject><div>x</div></foreignObject></svg></p>": "a\nx",
    "<svg><text><![CDATA[a<b>c]]></text></svg><![CDATA[no]]>d": "a<b>c\nd",
    "<table><tr><td>a<svg><tr><td>no</svg><td>b</table>": "a  b",
    "<map name=m>seen<area></map>": "seen",
    # an open head ends at text and at any tag that is no head matter
    "<head><title>T</title>Hello <b>world</b>": "Hello world",
    "<head><title>T</title><a href=x>link</a> after": "link after",
    "<head><meta><span>s<div>block</div></span>t": "s\nblock\nt",
    "<head><title>T</title><script>x</script><img alt=i>seen": "seen",
    "<head> <link> <style>s</style> <base>&nbsp;x": "\xa0x",
    "<head><template><b>no</b></template><noscript>no</noscript><custom-tag>yes": "yes",
    "<html><head><title>T</title></head><body>a<head>b</head>c": "abc",
    "a<head>b": "ab",
    "<head><html><body>x": "x",
    "<head><title>T</title></br>x": "x",
}


@pytest.mark.parametrize("source", FOREIGN_AND_HEAD)
def test_formulas_drawings_and_open_heads(source):
    assert H.page_text(source)[0] == FOREIGN_AND_HEAD[source]


def test_no_drawing_is_too_deep_or_too_broken():
    began = time.time()
    for bad in ("<svg>", "<svg><p>", "<math><mi>", "<svg><foreignObject>", "<svg><![CDATA[", "<head>", "<svg><text/>", "<svg a=", "<math><td>"):
        H.page_text(bad * 10_000)
    assert H.page_text("<svg><g a" + "=" * 200_000 + "'/><text>x")[0] in ("", "x")
    assert time.time() - began < 60


DEEP = "<div>" * 520
HIDDEN_DEEP_AND_STYLED = {
    DEEP + "<p hidden>secret</p>seen": "seen",
    DEEP + "<div hidden><div>a</div>secret<div><div>b</div></div></div>seen": "seen",
    DEEP + "<section><div style='display:none'><p>a<p>b</div>seen</section>": "seen",
    DEEP + "<span style='visibility:hidden'>no<b>no</b><i style='visibility:visible'>yes</i></span>seen": "yesseen",
    DEEP + "<svg>no<g>no<text>drawn</text></g></svg>seen": "drawn\nseen",
    "<style>.x{display:none}</style><p class=x>css</p>seen": "seen",
    "<p class='a x'>css</p>seen<style>/* .y{} */ p.x , #z { color:red; DISPLAY : None }</style><p id=z>no</p>": "seen",
    "<style>.x{display:none} p.x{display:block}</style><p class=x>seen<span class=x>no</span>": "seen",
    "<style>p.x{display:block} .x{display:none}</style><p class=x>seen": "seen",
    "<style>.x{display:none!important} #i{display:block}</style><p class=x id=i style='display:block'>no</p>seen": "seen",
    "<style>.x{display:none}</style><p class=x style='display:block'>seen": "seen",
    "<style>@media print{.x{display:none} .y{display:none}} .y{visibility:hidden}</style><p class=x>seen<p class=y>no<b style='visibility:visible'>yes": "seen\n\nyes",
    "<style media=print>.x{display:none}</style><p class=x>seen": "seen",
    "<style>div .x, .x:hover, [class=x], .x > p {display:none}</style><p class=x>seen": "seen",
    "<style>.x{display:none</style><p class=x>no</p>seen": "seen",
    "<style>{}}{ .x, {display:none} @media {</style><p class=x>seen": "seen",  # no valid selector is left
}


@pytest.mark.parametrize("source", HIDDEN_DEEP_AND_STYLED)
def test_hidden_stays_hidden(source):
    assert H.page_text(source)[0] == HIDDEN_DEEP_AND_STYLED[source]


def test_many_style_rules_and_deep_hidden_elements_are_no_trouble():
    began = time.time()
    H.page_text("<style>" + ".a{display:none}" * 50_000 + "{" * 50_000 + "</style>" + "<p class=a>x" * 50)
    H.page_text("<div hidden>" * 50_000 + "x" + "</div>" * 50_000)
    H.page_text("<span style='visibility:hidden'>" * 20_000)
    assert time.time() - began < 60


class Plain(html.parser.HTMLParser):
    """A second, plain reader for well-formed pages: visible characters in order, without layout."""

    UNSEEN = ("script", "style", "head", "template", "noscript", "title", "iframe", "object", "audio", "video", "canvas")
    ALONE = ("br", "img", "hr", "meta", "link", "input", "wbr", "area", "source", "col", "base", "embed", "param", "track")

    def __init__(self):
        super().__init__()
        self.open, self.out = [], []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag not in self.ALONE:
            style = (a.get("style") or "").replace(" ", "")
            self.open.append((tag, tag in self.UNSEEN or "hidden" in a or "display:none" in style or "visibility:hidden" in style))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        if not any(unseen for _, unseen in self.open):
            self.out.append(data)


def test_query_shows_what_a_plain_reader_sees_on_all_pages(spark):
    """The words of all pages of the table, each as often, against a reader made on the standard library's tokenizer."""
    from collections import Counter

    from govframe.llm.queries import op3_html_text

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "html").collect()
    got = {r.page_id: r.text for r in op3_html_text(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(pages)
    for p in pages:
        plain = Plain()
        plain.feed(p.html or "")
        plain.close()
        assert Counter(re.findall(r"[^\W\d_]+", got[p.page_id])) == Counter(re.findall(r"[^\W\d_]+", " ".join(plain.out))), p.page_id


def nested(depth, inside):
    return "<table><tr><td>n<td>" * depth + inside + "</table>" * depth


WIDE_AND_NESTED = {
    # a cell of any width is aligned
    f"<table><tr><td>{'w' * 90}<td>a<tr><td>x<td>b</table>": f"{'w' * 90}  a\nx{' ' * 91}b",
    # one that spans columns too narrow for it moves what follows to a line below, in its place
    "<table><tr><td colspan=2>very wide cell<td>a<tr><td>x<td>y<td>b</table>": "very wide cell\n      a\nx  y  b",
    # tables in tables keep their columns, however deep
    nested(12, "<table><tr><td>long<td>1<tr><td>s<td>2</table>"): "n  " * 12 + "long  1\n" + "   " * 12 + "s     2",
    # wide characters take two columns, combining marks none
    "<table><tr><td>\u6f22\u5b57<td>a<tr><td>abcd<td>b<tr><td>e\u0301<td>c</table>": "\u6f22\u5b57  a\nabcd  b\ne\u0301     c",
}


@pytest.mark.parametrize("source", WIDE_AND_NESTED)
def test_cells_of_wide_and_nested_tables_are_aligned(source):
    assert H.page_text(source)[0] == WIDE_AND_NESTED[source]


def test_padding_stays_in_proportion_and_no_text_is_lost():
    began = time.time()
    wide = "".join(f"<td>{'w' * 80}" for _ in range(900))
    pages = [
        "<table><tr>" + wide + "<tr><td colspan=899><td>seen" * 5_000 + "</table>",
        nested(170, "x<br>" * 20_000),
        "<table><tr><td>" + "w" * 200_000 + "<td>a" + "<tr><td><td>b" * 20_000 + "</table>",
    ]
    for page, word, times in zip(pages, ("seen", "x", "b"), (5_000, 20_000, 20_000), strict=True):
        text = H.page_text(page)[0]
        assert text.count(word) == times
        assert len(text) < 200 * len(page)
    assert time.time() - began < 60
