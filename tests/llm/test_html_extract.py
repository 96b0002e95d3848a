import pytest

from tidemark.llm import html_extract as H

from .conftest import with_clash

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div><main><article>
<header><h1>Head &amp; line</h1><span>by someone</span></header><p>First <b>bold</b>
   text&nbsp;here.<br>More<p>Second &lt;p&gt; &#233;<script>var x="</p>";</script></p><ul><li>one<li>two</ul>
<div class="ad-box">Buy</div><form>name<input></form><section class="comments"><p>Nice!</p></section></article></main>
<aside>side</aside><footer>&copy; me</footer></body></html>"""


def pages(spark, rows):
    return with_clash(spark.createDataFrame(rows, "page_id long, url string, html string"))


def test_article_without_the_rest(spark):
    rows = [(1, "http://a.example/x", PAGE), (2, None, None), (3, "http://a.example/", ""), (1, "http://a.example/x", PAGE),
            (4, "x", "plain <b>text</b> &am &amp"), (5, "http://b.example", "<p>cut <a hre")]
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in H.extract(pages(spark, rows)).collect()}
    text = "Head & line\nFirst bold text here. More\nSecond <p> é\none\ntwo"
    assert got[(1, "http://a.example/x")] == (text, len(text))
    assert got[(2, None)] == ("", 0) and got[(3, "http://a.example/")] == ("", 0)
    assert got[(4, "x")][0] == "plain text &am &" and got[(5, "http://b.example")][0] == "cut"
    assert H.extract(pages(spark, rows)).count() == 6 and H.extract(pages(spark, [])).count() == 0


def test_constant_nodes_of_a_host_are_template(spark):
    page = "<body><div><p>Read our other site too</p><h2>Title {0}</h2><p>Story {0} about thing {0}.</p>{1}<p>Same closing words</p></div></body>"
    rows = [(i, "https://u@Host.example:80/p", page.format(i, "<table><tr><td>x" + str(i) + "</table>" if i % 2 else "")) for i in range(8)]
    rows += [(100 + i, "https://host.example:80/p", rows[0][2]) for i in range(20)]  # copies count once
    rows += [(900 + i, "https://few.example/", page.format(i, "")) for i in range(3)]
    got = {r.page_id: r.text for r in H.extract(pages(spark, rows)).collect()}
    assert got[0] == got[110] == "Title 0\nStory 0 about thing 0."
    assert got[1] == "Title 1\nStory 1 about thing 1.\nx1"
    assert got[900].startswith("Read our other site too\nTitle 0")


def test_each_layout_of_a_host_has_its_template(spark):
    one = "<body><div><h1>Title {0}</h1><p>Story {0}.</p><dl><dt>Always here</dt><dd>and here</dd></dl></div></body>"
    two = "<body><section><ul><li>Same hint</li></ul><table><tr><td>Fixed cell</td><td><p>Body {0}</p></td></tr></table><pre>Fixed end</pre></section></body>"
    odd = "<body><div><h1>Title {0}</h1><p>Story {0}.</p><dl><dt>Always here</dt><dd>and here</dd></dl><blockquote>Seldom, but the same</blockquote></div></body>"
    rows = [(i, "http://mixed.example/", one.format(i)) for i in range(12)]
    rows += [(20 + i, "http://mixed.example/", two.format(i)) for i in range(8)]
    rows += [(40 + i, "http://mixed.example/", odd.format(i)) for i in range(5)]  # a node that the pivot lacks
    rows += [(60, "http://mixed.example/", "<h2>Alone</h2>"), (61, "http://mixed.example/", two.format(99).replace("<ul>", "<ol><li>x</ol><ul>"))]
    got = {r.page_id: r.text for r in H.extract(pages(spark, rows)).collect()}
    assert got[3] == "Title 3\nStory 3." and got[23] == "Body 3" and got[43] == "Title 3\nStory 3."
    assert got[60] == "Alone" and got[61] == "x\nBody 99"


def test_many_layouts_take_several_rounds(spark):
    tags = "section table dl ul ol pre blockquote address figure details".split()
    page = "<body>{0}<p>Same words</p><h1>About {2}</h1>{1}</body>"
    rows = [(100 * k + i, "http://h.example/", page.format("".join(f"<{t}>" for t in [t] * 6), "".join(f"</{t}>" for t in [t] * 6), i))
            for k, t in enumerate(tags) for i in range(6)]
    assert {r.text.split()[0] for r in H.extract(pages(spark, rows)).collect()} == {"About"}


def test_menus_without_an_article_go():
    html = "<div><ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul><p>Text with <a href=3>a link</a> in it.</p></div>"
    assert [t for _, t in H.main_blocks(H.tree(html))] == ["Text with a link in it."]


def texts(html):
    return [t for _, t in H.main_blocks(H.tree(html))]


def test_wrapped_bodies_stay():
    search = "<form>find<input></form>"
    story = "<p>A long story about many things.</p>"
    assert texts(f"<form><nav>x</nav><article>{story}{search}</article></form>") == ["A long story about many things."]
    assert texts(f"<div>{search}</div><fieldset><main>{story}</main></fieldset>") == ["A long story about many things."]
    assert texts(f"<body><form><div>{story}<p>And more.</p></div><fieldset>name</fieldset></form>{search}</body>") \
        == ["A long story about many things.", "And more."]
    assert texts(f"<div>{story}</div><form hidden><article>{story}</article></form>{search}") == ["A long story about many things."]


def test_articles_win_only_with_most_of_the_content(spark):
    body = "<div><p>The main text stands {0} in plain blocks, and it is long.</p></div>"
    card = "<article><p>Teaser {0}</p></article>"
    assert texts(card.format(1) + body.format("here")) == ["Teaser 1", "The main text stands here in plain blocks, and it is long."]
    banner = "<div><p>The same long words of welcome stand on each page of this host.</p></div>"  # template, so the article has most of the rest
    rows = [(i, "http://h.example/", f"<body>{banner}<article><p>Short story {i}.</p></article><div><p>by {i}</p></div></body>") for i in range(6)]
    rows += [(9, "http://o.example/", card.format(1) + body.format("here"))]
    got = {r.page_id: r.text for r in H.extract(pages(spark, rows)).collect()}
    assert got[3] == "Short story 3." and got[9].endswith("it is long.")


def test_simple_tree_matching_and_alignment():
    a = ("r", (("h", ()), ("p", ()), ("d", (("x", ()), ("y", ())))))
    b = ("r", (("n", ()), ("p", ()), ("d", (("y", ()),))))
    assert H.simple_tree_match(a, b) == 4 and H.simple_tree_match(a, a) == 6 and H.simple_tree_match(a, ("q", ())) == 0
    assert H.align(a, b) == {0: 0, 2: 2, 3: 3, 4: 5}
    assert H.read_shape(H._write_shape(a)) == a


def test_deep_and_long_pages():
    deep = "<div>" * 3000 + "core" + "</div>" * 10
    root = H.tree(deep)
    H.read_shape(H._write_shape(H.shape(root)))
    assert [t for _, t in H.main_blocks(root)] == ["core"]
    assert len(H.main_blocks(H.tree("<p>x " * 50_000))) == 50_000


def test_deep_pages_are_extracted(spark):
    deep = "<div>" * 3000 + "{0}" + "</div>" * 10
    rows = [(1, "http://lone.example/", deep.format("core"))]
    rows += [(2 + i, "http://many.example/", deep.format(f"<p>story {i}</p>" + "<table><tr><td>more</table>" * (i % 2))) for i in range(4)]
    rows.append((9, "http://twins.example/", "<section>" + 2 * ("<div>" * 3000 + "twin" + "</div>" * 3000)))
    got = {r.page_id: r.text for r in H.extract(pages(spark, rows)).collect()}
    assert got[1] == "core" and got[2] == "story 0" and got[3] == "story 1\nmore" and got[9] == "twin\ntwin"


def test_pages_keep_every_paragraph_of_the_article(spark, sf):
    """Against a plain reading of the generated pages, whose article holds only text blocks."""
    import html
    import re
    got = {r.page_id: r.text for r in H.extract(spark.read.parquet(f"{sf}/pages.parquet")).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        body = re.search("<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", body)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("word", ["share-price", "social-policy", "notice-of-meeting", "related", "promo-text", "navigation-history", "ad-hoc"])
def test_a_paragraph_of_the_article_stays_whatever_its_class(word):
    html = f"<article><h1>Head</h1><p>One.</p><p class='{word}'>Two words.</p><div class='share-bar'><a href=x>Share</a></div><p class=ad>Buy</p></article>"
    assert [t for _, t in H.main_blocks(H.tree(html))] == ["Head", "One.", "Two words."]


def test_form_elements_in_a_sentence():
    html = ("<article><p>The price <output>5</output> is <label>net</label> of <button>tax</button> today.</p><label>Name</label><button>Send</button>"
            "<p><button>Share</button></p><form><label>Mail</label> address</form></article>")
    assert [t for _, t in H.main_blocks(H.tree(html))] == ["The price 5 is net of tax today."]


def test_unclosed_and_stray_tags_take_linear_time():
    import time
    took = []
    for n in (3_000, 30_000):
        start = time.perf_counter()
        for html in ("<b>" * n + "<p>x" * n, "<div>" * 50 + "</i>" * n, "<b>" * n + "</i>" * n, "<ul>" + "<li>x" * n, "<table>" + "<tr><td>x" * n):
            H.tree(html)
        took.append(time.perf_counter() - start)
    assert took[1] < 60 * took[0] + 1


def plain_tree(html):
    """Parsing with a search up the tree for every tag, without counts of open ones."""
    class Plain(H._Builder):
        def _end(self, tags, fence=H.FENCE):
            n = self.at
            while n.parent is not None and n.tag not in fence:
                if n.tag in tags:
                    self.at = n.parent
                n = n.parent
            if n.parent is not None and n.tag in tags:
                self.at = n.parent

        def handle_endtag(self, tag):
            n = self.at
            while n.parent is not None and n.tag != tag:
                n = n.parent
            if n.parent is not None:
                self.at = n.parent
    b = Plain()
    b.feed(html)
    b.close()
    return b.root


def test_counts_of_open_tags_change_no_tree():
    import random
    rng = random.Random(3)

    def flat(n):
        return n if isinstance(n, str) else (n.tag, tuple(flat(c) for c in n.children))
    for _ in range(400):
        tags = [rng.choice(["p", "b", "i", "div", "li", "ul", "td", "tr", "table", "h1", "article", "dd", "dt", "svg", "br", "option"]) for _ in range(rng.randrange(40))]
        html = "".join(rng.choice([f"<{t}>", f"<{t}>x", f"</{t}>", f"<{t}/>"]) for t in tags)
        assert flat(H.tree(html)) == flat(plain_tree(html)), html


def test_a_page_is_parsed_without_counting_lines_or_comparing_deep_shapes(monkeypatch):
    """What a page costs is in proportion to its tags: no position is kept, and a class
    or an equal subtree is worked on once."""
    import _markupbase
    monkeypatch.setattr(_markupbase.ParserBase, "updatepos", lambda *a: pytest.fail("lines are counted"))
    made = []
    monkeypatch.setattr(H, "_noise", lambda n, inside, held=frozenset(), real=H._noise: made.append(n) or real(n, inside, held))
    root = H.tree("<header>top\n</header><article>" + "<div><p>a\nb</p></div>" * 300 + "</article>")
    first, second = H.shape(root)[1]
    assert len(second[1]) == 1 and second[1][0] == ("div", (("p", ()),))
    assert [t for _, t, _ in H.text_blocks(root)] == ["a b"] * 300
    assert len(made) == 602
