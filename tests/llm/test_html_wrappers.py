"""Main text by inferred wrappers, against Python's own HTML parser and hand-made sites."""

from html.parser import HTMLParser

import pytest

from conftest import TESTDATA
from parcelmart.llm import html_wrappers as m
from parcelmart.llm import queries

SCHEMA = "page_id long, url string, html string, text string, host string"


class Article(HTMLParser):
    """All text inside <article>, block tags and breaks as spaces."""

    def __init__(self, source):
        super().__init__(convert_charrefs=True)
        self.inside, self.parts = False, []
        self.feed(source)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag not in ("a", "b", "i", "em", "strong", "span"):
            self.parts.append(" ")

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag not in ("a", "b", "i", "em", "strong", "span"):
            self.parts.append(" ")

    def handle_data(self, data):
        if self.inside:
            self.parts.append(data)


def extracted(spark, pages):
    df = spark.createDataFrame([(*p, "x", "y") for p in pages], SCHEMA)
    return {(r.page_id, r.text) for r in m.extract(df).collect()}


def test_query_equals_a_parser(spark):
    sf_dir = str(TESTDATA / "sf0.01")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    found = {r.page_id: r for r in queries.op9_html_main_text(spark, sf_dir).collect()}
    assert len(found) == len(pages)
    for page in pages:
        expected = " ".join("".join(Article(page.html).parts).split())
        assert (found[page.page_id].url, found[page.page_id].text, found[page.page_id].n_chars) == (page.url, expected, len(expected))


def test_what_is_dropped_and_kept(spark):
    boiler = (
        '<header class="site"><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div id="cookie-notice">We use cookies</div>'
        '<div class="sidebar-left">Side</div><aside>More</aside><form><p>Search</p></form><noscript>Turn it on</noscript>'
    )
    main = (
        '<article class="post"><header><h2>Title &amp; more</h2></header><p>One <b>bo</b>ld <a href="x">link</a>.<br>Next&nbsp;line</p>'
        '<div class="ad">Buy</div><script>var a="</p>";</script><style>p{}</style><!-- <p>no</p> -->'
        "<ul><li>first<li>second</ul><table><tr><td>a<td>b</table><p>last &lt;tag&gt; &#233;"
        '<section class="comments"><article><p>Reader says</p></article></section><footer>Tags</footer></article>'
    )
    expected = "Title & more One bold link. Next line first second a b last <tag> é"
    pages = [(i, f"http://a.example/{i}", f"<html><body>{boiler}{main}<footer>(c)</footer></body></html>") for i in range(3)]
    assert extracted(spark, pages) == {(i, expected) for i in range(3)}


def test_pages_without_an_article(spark):
    """Slots of the wrapper that vary count; what is the same everywhere or links only does not."""
    page = lambda i: f"<body><div><ul><li><a href=a>go {i}</a></li><li><a href=b>to {i}</a></li></ul><p>Welcome to us</p><p class=t>Text {i} goes</p>{'<p class=t>on</p>' * i}</div></body>"
    pages = [(i, "http://b.example/x", page(i)) for i in range(8)]
    assert extracted(spark, pages) == {(i, " ".join([f"Text {i} goes", *["on"] * i])) for i in range(8)}
    named = [(i, "http://c.example/x", f"<body><div class='content'><p>t {i}</p></div><div>other {i}</div></body>") for i in range(3)]
    assert extracted(spark, named) == {(i, f"t {i}") for i in range(3)}


def test_edge_cases(spark):
    pages = [
        (1, None, None),
        (2, "", ""),
        (3, "no url", "just text &am"),
        (None, "http://d.example", "<article>no id"),
        (5, "http://d.example", "<article><p>a < b <i>c"),
        (6, "http://D.example:80/x", "<article><p>twice</p></article>"),
        (6, "http://D.example:80/x", "<article><p>twice</p></article>"),
        (7, "http://d.example", "<div>" * 5000 + "<article><p>deep</p></article>"),
        (8, "http://d.example", "<article>" + "<p>p</p><h2>h</h2>" * 20_000 + "</article>"),
        (9, "http://d.example", "<article><p class='a\"b>odd</p></article>"),
        (10, "http://d.example", "<nav>only menus</nav><svg/><script>x"),
    ]
    df = spark.createDataFrame([(*p, "x", "y") for p in pages], SCHEMA)
    found = m.extract(df).collect()
    assert len(found) == len(pages)
    texts = {r.page_id: r.text for r in found}
    assert texts[1] == texts[2] == texts[10] == ""
    assert texts[3] == "just text &am" and texts[None] == "no id" and texts[5] == "a < b c" and texts[6] == "twice"
    assert texts[7] == "deep" and texts[8] == " ".join(["p h"] * 20_000)
    assert all(r.n_chars == len(r.text) for r in found)


def test_empty_table(spark):
    assert m.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def wrapper_of(*sources):
    wrapper = m.Wrapper()
    for source in sources:
        wrapper.add(m.Wrapper.of(m.Page(source)))
    return m.as_text(wrapper.tree)


def test_wrappers_are_union_free_expressions():
    assert wrapper_of("<div><p>a</p></div>") == 'div[p["a"]]'
    assert wrapper_of("<div><p>a</p></div>", "<div><p>b</p></div>") == "div[p[#]]"
    assert wrapper_of("<div><p>a</p></div>", "<div><p>a</p><p>c</p></div>") == "div[p[#]+]"
    assert wrapper_of("<div><h1>t</h1><p>a</p></div>", "<div><p>a</p></div>") == 'div[h1["t"]? p["a"]]'
    assert wrapper_of("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "<dl><dt>a<dd>b</dl>") in ("dl[(dt[#] dd[#])*]", 'dl[(dt[#] dd[#])? dt["a"]? dd["b"]?]', 'dl[dt["a"]? dd["b"]? (dt[#] dd[#])?]', 'dl[dt["a"]? dd["b"]? (dt[#] dd[#])*]', 'dl[(dt[#] dd[#])* dt["a"]? dd["b"]?]')


def test_order_of_pages_does_not_change_what_is_extracted():
    sources = ["<article><h1>a</h1><p>b</p></article>", "<article><p>b</p><ul><li>c</ul></article>", "<div class=ad>x</div><article><p>d</p></article>"]
    ways = []
    for order in (sources, sources[::-1], sources[1:] + sources[:1]):
        wrapper = m.Wrapper()
        for source in order:
            wrapper.add(m.Wrapper.loads(m.Wrapper.of(m.Page(source)).dumps()))
        ways.append([m.main_text(m.Page(s), wrapper.main_paths()) for s in sources])
    assert ways[0] == ways[1] == ways[2] == ["a b", "b c", "d"]


def test_slots_decide_what_is_main_text(spark):
    """Texts that all pages have stay in an article, but for short ones whose words speak against them too."""

    def page(i):
        more = f"<section><p>aside {i}</p></section>" if i % 2 else ""
        return (
            f"<body><article><h1>Title {i}</h1><p>Share this page</p><h2>Summary</h2>{more}<p>All about {i}</p>"
            f"<p>Read on</p><p>First {i}</p><p>Second {i}</p><div>Our terms apply</div></article></body>"
        )

    wanted = lambda i: f"Title {i} Summary {f'aside {i} ' * (i % 2)}All about {i} Read on First {i} Second {i} Our terms apply"
    pages = [(i, "http://e.example/x", page(i)) for i in range(8)]
    assert extracted(spark, pages) == {(i, wanted(i)) for i in range(8)}


@pytest.mark.parametrize("count", [1, 2, 4, 5, 50])
def test_sentences_that_all_articles_share_stay(spark, count):
    """The same text for any number of pages, with an article and without."""
    said = "<p>We met the mayor at the town hall.</p>"
    article = lambda i: f"<body><nav>Menu</nav><article><h1>Title {i}</h1>{said}<p>Report number {i}</p><p>The end.</p></article></body>"
    plain = lambda i: f"<body><div>Home of news</div><h1>Title {i}</h1>{said}<p>Report number {i}</p><div>All our pages</div></body>"
    pages = [(i, "http://t.example/x", article(i)) for i in range(count)]
    pages += [(1000 + i, "http://u.example/x", plain(i)) for i in range(count)]
    text = "Title {0} We met the mayor at the town hall. Report number {0}"
    found = dict(extracted(spark, pages))
    assert {found[i] for i in range(count)} == {text.format(i) + " The end." for i in range(count)}
    # Without tags, what never changes before and after the text goes once another page shows it.
    bare = text if count > 1 else f"Home of news {text} All our pages"
    assert {found[1000 + i] for i in range(count)} == {bare.format(i) for i in range(count)}


def test_pages_are_aligned_with_the_expression():
    p, q, group = ["p", "?", []], ["q", "", []], ["()", "+", [["a", "", []], ["p", "*", []]]]
    placed = lambda nodes, tags: m.Expression(nodes).positions([[t, []] for t in tags])
    assert placed([p, q, p], "q p".split()) == [1, 2]
    assert placed([p, q, p], "p q".split()) == [0, 1]
    assert placed([p, group, q, p], "a p a p p q p".split()) == [1, 2, 1, 2, 2, 3, 4]
    assert placed([["p", "?", []], ["p", "", []]], ["p"]) == [1]


def test_a_class_word_alone_drops_no_main_text(spark):
    """Layout classes name what else is on the page; the varying bulk with the article stays, comments do not."""
    side, wide = "<div class='sidebar'><p>Top {0}</p></div>", "Long words of page {0} go on and on"
    sites = {
        "f": (f"<body>{side}<div class='content-with-sidebar'><article><p>{wide}</p></article></div></body>", wide),
        "g": (f"<body>{side}<article class='post has-sidebar'><p>{wide}</p></article><div>Else {{0}}</div></body>", wide),
        "h": (f"<body>{side}<div class='page sidebar-layout'><main><p>{wide}</p></main><div class='share'>Share {{0}}</div></div><p>end {{0}}</p></body>", wide),
        "i": (f"<body><article class='social'><p>{wide}</p></article><div class='related widget'><article>More {{0}}</article></div></body>", wide),
        "j": (f"<body><article><p>Short {{0}}</p><div class='comments'><article>{wide * 3}</article></div></article></body>", "Short {0}"),
        "k": (f"<body><article><p>Short {{0}}</p><div class='widget'><p>{wide * 3}</p></div></article></body>", "Short {0}"),
        "l": (f"<body><main><p>Short {{0}}</p></main><section class='comments'><article class='post'>{wide}</article></section></body>", "Short {0}"),
    }
    pages, wanted = [], set()
    for k, (name, (html, text)) in enumerate(sites.items()):
        for i in range(6):
            pages.append((10 * k + i, f"http://{name}.example/x", html.format(i)))
            wanted.add((10 * k + i, text.format(i)))
    assert extracted(spark, pages) == wanted


def test_elements_of_any_depth_are_read_as_such(spark):
    """Menus, comments and articles below MAX_DEPTH, and what follows many open blocks."""
    deep, shut = "<div>" * 300, "</div>" * 300
    parts = "<nav>menu</nav><header>Site</header><div class='ad'>Buy</div>{}<aside>More</aside><footer>end</footer>"
    article = "<article><header>Title</header><h2>Head</h2>one<p>two<p>three<ul><li>four<li>five</ul>six<form>ask</form><div class='comments'><p>says</p></div></article>"
    items = "<ul>" + "<li><p>x" * 3 + "</ul>"
    pages = [
        (1, "http://m.example", f"<body>{deep}{parts.format(article)}{shut}<p>after</p>"),
        (2, "http://n.example", f"<body><article>{deep}<p>in</p><aside>notice</aside>{items}{shut}<p>on</p></article><footer>out</footer>"),
        (3, "http://o.example", f"<body>{deep}<main><p>in main</p></main><p>beside</p>"),
        (4, "http://p.example", f"<body>{deep}<div class='content'><p>named</p></div><p>beside</p>"),
        (5, "http://q.example", "<div>" * 100_000 + "<article>far</article><nav>menu</nav>"),
    ]
    texts = {1: "Title Head one two three four five six", 2: "in x x x on", 3: "in main", 4: "named", 5: "far"}
    assert extracted(spark, pages) == set(texts.items())
