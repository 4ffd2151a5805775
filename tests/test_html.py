import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import html, markup

PAGE = """<!DOCTYPE html><html lang="en"><head><title>Case 7</title><style>p{margin:0}</style></head>
<body class="page"><nav><a href="/">Home</a> <a href="/search">Back</a></nav>
<div id="main" class="wide content"><h2>Ms B against C Ltd</h2><script src="count.js"></script>
<p>The claim is allowed.</p><style>h2{top:1px}</style></div>
<aside>Latest news</aside><script>count(7)</script></body></html>"""


def clean(page, **options):
    return html.clean_page(page.encode(), **options).decode()


def test_keeps_content_drops_the_rest():
    kept = clean(PAGE)
    assert kept == (
        '<div id="main" class="wide content"><h2>Ms B against C Ltd</h2>\n<p>The claim is allowed.</p></div>'
    )


@pytest.mark.parametrize("page,expected", [
    # The class is one token of several, the first container counts, nesting is respected.
    ('<body><div class="x content">a<div>b</div>c</div><div class="content">z</div></body>',
     '<div class="x content">a<div>b</div>c</div>'),
    ('<body><div class="content-x">n</div><div CLASS=content>y</div></body>', "<div CLASS=content>y</div>"),
    # A container without text falls back to the body; scripts, comments and spaces are no text.
    ('<body>all<div class="content"><script>s()</script><!-- c -->&nbsp; </div></body>',
     '<body>all<div class="content"><!-- c -->&nbsp; </div></body>'),
    ("<html><head><title>t</title></head><body class=b><p>x</p><style>y</style></body></html>",
     "<body class=b><p>x</p></body>"),
    # Without a body tag: what the body would hold.
    ("<!DOCTYPE html><html><head><title>t</title></head><p>x</p></html>", "<p>x</p>"),
    ("<title>t</title>plain <b>text</b>", "plain <b>text</b>"),
    ("", ""),
    # Missing end tags: closed by what surrounds them.
    ('<body><div class="content"><p>a<p>b', '<div class="content"><p>a<p>b'),
    ('<body><table><tr><td><div class="content">in</td><td>out</td></tr></table></body>', '<div class="content">in'),
    ('<body><div class="content">a</p></span></article>b</div>c</body>', '<div class="content">a</p></span></article>b</div>'),
    ('<body><div class="content"><table><tr><td></div>cell</td></tr></table>end</div>x</body>',
     '<div class="content"><table><tr><td></div>cell</td></tr></table>end</div>'),
    # Markup inside scripts, comments and attributes is no markup.
    ('<body><script>"<div class=content>no</div>"</script><!-- <div class="content">no</div> -->'
     '<div class="content" title="a > b </div>">yes</div></body>', '<div class="content" title="a > b </div>">yes</div>'),
    ('<body><div class="content">a<!-- <script>k</script> --><SCRIPT src=x>j</SCRIPT >b</div></body>',
     '<div class="content">a<!-- <script>k</script> -->b</div>'),
    ("<body>a<script>never closed", "<body>a"),
    ('<body><div class="content"/><p>x</p></body>', '<body><div class="content"/><p>x</p></body>'),
])
def test_clean(page, expected):
    assert clean(page) == expected


def test_container_is_a_parameter():
    assert clean("<body><main class='m a'>x</main></body>", tag="main", css_class="a") == "<main class='m a'>x</main>"


def test_charsets():
    assert html.clean_page("<body>é</body>".encode()) == "<body>é</body>".encode()
    latin = '<head><meta charset="iso-8859-1"></head><body>é</body>'.encode("latin-1")
    assert html.clean_page(latin) == "<body>é</body>".encode()
    assert html.clean_page("<body>é€</body>".encode("cp1252")) == "<body>é€</body>".encode()
    assert html.clean_page(b"\xff\xfe" + "<body>é</body>".encode("utf-16-le")) == "<body>é</body>".encode()
    assert html.clean_page(b"<meta charset=nonsense><body>x</body>") == b"<body>x</body>"


URL = "https://x.example/en/cases/p.html"
LINK = '<div class="related-file"><a class="download" href="{}">x</a></div>'


@pytest.mark.parametrize("page,expected", [
    ('<div class="content wide">\n</div><div class="box related-file"><ul><li>'
     '<a class="button download" href="/old/17/q.pdf">Get it</a></ul></div>', "https://x.example/old/17/q.pdf"),
    ('<div class="content"><b>Dismissed.</b></div>' + LINK.format("/q.pdf"), None),
    ('<div class="content"></div>', None),
    ('<div class="content"></div>' + LINK.format("/other.html"), None),
    # Script text counts as content here, comments do not; no container is an empty one.
    ('<div class="content"><script>s()</script></div>' + LINK.format("a.doc"), None),
    ('<div class="content"><!-- x -->&nbsp;</div>' + LINK.format("a.doc"), "https://x.example/en/cases/a.doc"),
    (LINK.format("../a.PDF?v=1&amp;w=2"), "https://x.example/en/a.PDF?v=1&w=2"),
    # The first link decides; one without href is none; it must lie within the div.
    ('<div class="related-file"><a class="download">y</a><a class="b download" href="n.html">x</a>'
     '<a class="download" href="/y.pdf">x</a></div>', None),
    ('<div class="related-file"></div><a class="download" href="/y.pdf">x</a>', None),
    ('<base href="https://b.example/q/"><div class="related-file"><p><a class="download" href="y.pdf">x</a></p></div>',
     "https://b.example/q/y.pdf"),
])
def test_attachment(page, expected):
    assert html.attachment_url(page.encode(), URL) == expected


def test_cards():
    page = """<ul><li class="each-item first"><h2 class="title"><a href="/d/1.html">ADJ-1<b>x</b></a></h2>
      <span class="date"> 05/01/2024 </span><p class="description">A &amp; B<br>more</p></li>
    <li class="other"><h2 class="title"><a href="/no">no</a></h2></li>
    <li class="each-item"><h2 class="title"><a href="d/2.pdf"></a></h2><div class="refNO"> R2 </div>
    <li class="each-item"><h2 class="title"><a>  </a></h2><span class="refNO">R3</span><p class="description"></p></li>
    <li class="each-item"><h2 class="title"><a href="http://[bad">B<!-- c -->x</b>y</a></h2></li>
    <li class="each-item"><h2><a href="/x">not a title</a></h2></li>
    <li class="each-item"><h2 class="title"><a href=""><i>icon</i> T5 <!-- c -->tail</a></h2></li></ul>"""
    got = html.listing_cards(page.encode(), URL)
    assert [tuple(c.values()) for c in got] == [
        (0, "ADJ-1", "A & B", "05/01/2024", "https://x.example/d/1.html"),
        (1, "R2", "", "", "https://x.example/en/cases/d/2.pdf"),
        (2, "", "", "", None),
        (3, "B", "", "", "http://[bad"),
        (4, None, "", "", None),
        (5, "T5", "", "", None),
    ]


def test_no_cards():
    assert html.listing_cards(b"<p>of 0 results</p>", URL) == []


def test_elements_nest():
    found = markup.elements("<div><p>a<p>b<ul><li>c<li>d</ul></div><br>e")
    names = [(e.name, e.parent.name if e.parent else None) for e in found]
    assert names == [("div", None), ("p", "div"), ("p", "div"), ("ul", "div"), ("li", "ul"), ("li", "ul"), ("br", None)]


def test_long_hostile_pages_stay_fast():
    for page in ("<div " * 20000, "<div a=\"" * 5000, "<!--" * 20000, "<script>" * 20000, "</div>" * 50000,
                 "<div>" * 20000, '<div class="content">' + "<p>" * 50000, "<body" + " =" * 50000):
        clean(page)


def test_errors_stay_in_their_row(spark):
    rows = spark.createDataFrame(
        [(1, b"<body>ok</body>"), (2, b"%PDF\x00\x01"), (3, None)], "i int, content binary"
    )
    found = rows.select("i", html.shell_attachment(F.col("content"), F.lit(URL)).alias("s"))
    got = {r["i"]: (r["s"]["value"], r["s"]["error"]) if r["s"] else None for r in found.collect()}
    assert got[1] == (None, None) and got[3] in (None, (None, None))
    assert got[2][0] is None and "binary response" in got[2][1]


def test_no_rule_stops_at_a_byte():
    pad = b"<!--" + b"x" * 6000 + b"-->"
    for early in (True, False):
        gap = b"" if early else pad
        page = b"<html><head>" + gap + b'<meta charset="iso-8859-15"></head><body><p>\xa4</p></body></html>'
        assert "€" in html.clean_page(page).decode()
        page = b"<html><head>" + gap + b'<base href="/base/"></head><body><div class="related-file"><a class="download" href="a.pdf">x</a></div></body>'
        assert html.attachment_url(page, "https://files.example/q") == "https://files.example/base/a.pdf"
        page = b"<html><body>" + gap + b'\x01<div class="content">text</div></body></html>'
        assert html.attachment_url(page, URL) is None


def test_a_batch_of_pages_is_not_held_as_objects():
    """Rows of a batch become Python objects a piece at a time; NULL, empty and very long pages are like any other."""
    pages = [b"<body>" + b"x" * 5000 + b"</body>"] * 3000 + [None, b"", b"<body>" + b"y" * 3_000_000 + b"</body>", b"<body>z"]
    batch = pa.array(pages, pa.binary())
    tracemalloc.start()
    found = html._by_row(html.clean_page, T.BinaryType(), batch)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.field(0).to_pylist() == [None if p is None else html.clean_page(p) for p in pages]
    assert found.field(1).null_count == len(pages) and len(html._by_row(html.clean_page, T.BinaryType(), batch[:0])) == 0
    assert peak < 15e6
