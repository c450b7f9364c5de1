import html
import re

import numpy as np
from conftest import SF01

from affinity.llm import html as H


def test_whole_table(spark):
    p = spark.read.parquet(f"{SF01}/pages.parquet")
    src = {r.page_id: r for r in p.collect()}
    got = H.extract(p).collect()
    assert len(got) == len(src)
    for g in got:
        page = src[g.page_id]
        body = re.search(r"<article>(.*?)(</article>|<footer|$)", page.html, re.S)[1]
        assert g.text == " ".join(html.unescape(re.sub(r"<[^>]+>", " ", body)).split())
        assert (g.url, g.n_chars) == (page.url, len(g.text))


def test_page_without_article():
    page = """<html><head><title>T</title></head><body><header><a href=/>Home</a> <a href=/x>News</a></header>
    <div id="cookie-notice">We use cookies</div>
    <div class="no-sidebar content"><h2>Head&nbsp;line</h2><p>A long paragraph &amp; more text, of some length, that counts as
    content, with <a href=x>one</a>link.</p><p>Short.<p>Another long paragraph here &#8212; with enough words to count.</div>
    <div class="sidebar"><p>Some side text</p></div><form><p>Your mail</p><input></form>
    <section class="comments"><p>A reader comment that is rather long, longer than many a paragraph of the page itself.</p></section>
    <footer>Imprint</footer><script>var x = "<p>no</p>";</script></body></html>"""
    assert H.main_text(page) == ("Head line A long paragraph & more text, of some length, that counts as content, with onelink. "
                                 "Short. Another long paragraph here — with enough words to count.")


def test_article_parts():
    page = ("<body><article class='post'><header><h1>Title</h1></header><p>One<br>two <b>three</b>four.</p>"
            "<aside>aside</aside><div class='ad'>buy</div><ul><li>a</li><li>b</li></ul><table><tr><td>c<td>d</table>"
            "<div class='comments'><article class='comment'>said someone at some length, as readers like to do</article></div>"
            "</article></body>")
    assert H.main_text(page) == "Title One two threefour. a b c d"


def test_odd_pages(spark):
    for page in (None, "", "   ", "<", "<p", "</p></div>", "<!-- x", "<script>never closed", "&amp;", "plain text", "<b>" * 3000 + "deep"):
        assert isinstance(H.main_text(page), str)
    assert H.main_text("plain text") == "plain text" and H.main_text(None) == ""
    long = "<article>" + "<p>word &lt;b&gt; word</p>" * 20000 + "</article>"
    assert H.main_text(long) == " ".join(["word <b> word"] * 20000)
    rows = [(1, None, None), (None, "u", "<p>x</p>"), (2, "u", ""), (2, "u", "")]
    p = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    assert sorted(map(str, map(tuple, H.extract(p).collect()))) == sorted(map(str, [
        (1, None, "", 0), (None, "u", "x", 1), (2, "u", "", 0), (2, "u", "", 0)]))
    assert H.extract(p.limit(0)).count() == 0


def test_smoothing_and_clusters():
    x = np.array([0.0, 0.0, 5.0, 5.0, 5.0, 0.0])
    s = H.smooth(x)
    assert np.allclose(H.smooth(np.ones(7)), 1.0) and s[3] > s[2] > s[1] > s[0]
    assert 1 < H.threshold(np.array([0.1, 0.2, 4.0, 5.0])) < 4


def test_head_left_open():
    story = "<article><h1>Title</h1><p>The story is told here.</p></article>"
    for page in (f"<html><head><title>T</title><body>{story}", f"<html><head><title>T</title><meta charset=x>{story}",
                 f"<head><title>T</title><script>var x;</script><div>{story}</div>"):
        assert H.main_text(page) == "Title The story is told here."
    assert H.main_text("<html><head><title>T</title>The story is told here.") == "The story is told here."
    assert H.main_text("<html><head><title>T</title></head><p>The story") == "The story"


def test_page_in_a_form():
    parts = "<h1>Title</h1><p>The story is told here.</p><select><option>no</select><button>Send</button>"
    for page in (f"<body><form id=f>{parts}</form></body>", f"<body><form><article>{parts}</article></form>",
                 f"<body><form><main>{parts}</main></form><footer>Imprint</footer>",
                 f"<body><a href=#c>Top</a><form><nav>Menu</nav><div>{parts}</div></form></body>"):
        assert H.main_text(page).endswith("Title The story is told here.") and "Send" not in H.main_text(page)
    assert H.main_text("<body><article><p>The story.</p><form><p>Sign up here, and never miss a story</p></form></article>") == "The story."


def test_blocks_left_unclosed():
    story = "<article><h1>Title</h1><p>The story is told here.</p><aside>aside</aside></article>"
    for block in ("<nav><a href=/>Home</a>", "<aside><p>By the way", "<div class='notice'><p>We use cookies</p>"):
        assert H.main_text(f"<body>{block}{story}</body>") == "Title The story is told here."
        assert H.main_text(f"<body><div>{block}{story}</div></body>") == "Title The story is told here."
    assert H.main_text("<body><aside><p>Title</p><div><p>The story is told here.</p></div></body>") != ""
    # what follows an article stays out, also unclosed
    assert H.main_text(f"<body>{story}<section class='comments'><article>said someone</article>") == "Title The story is told here."
    assert H.main_text(f"<body><aside><article>teaser</article></aside>{story}") == "Title The story is told here."


def test_names_of_topics_and_layouts():
    parts = ('<h2 id="copyright">Rights</h2><p>About rights.</p><section id="related-work"><p>Others did.</p></section>'
             '<section id="navigation"><p>How to find it.</p></section><div class="section" id="comments"><p>Remarks.</p></div>')
    text = "Rights About rights. Others did. How to find it. Remarks."
    assert H.main_text(f"<body><article>{parts}</article></body>") == text
    for name in ("content-with-sidebar", "reader-view", "side-by-side", "comment-enabled post", "layout-sidebar-right", "menu", "reader"):
        assert H.main_text(f'<body><p>Top</p><div class="{name}"><article>{parts}</article></div></body>') == text
        assert H.main_text(f'<body><div id="{name}"><div class="sidebar"><main><article>{parts}</article></main></div></div></body>') == text
        assert H.main_text(f'<body><div class="{name}"><div class="sidebar"><article>teaser</article></div>'
                           f'<article>{parts}</article></div></body>') == text
    assert H.main_text('<main><p>The story.</p><section id="navigation"><p>How to find it.</p></section></main>') == "The story. How to find it."
    for name in ("content-with-sidebar", "reader-view", "side-by-side", "comment-enabled post"):
        assert H.main_text(f'<body><div class="{name}"><p>The story is told here.</p></div></body>') == "The story is told here."


def test_names_of_parts():
    names = ("ad", "ad-container", "sidebar-left", "comment-list", "comments-area", "related-posts", "share-buttons", "cookie-notice",
             "nav_menu", "menu-item-3", "widget", "newsletter-form", "my-footer")
    for name in names:
        assert H.main_text(f'<article><p>The story.</p><div class="{name}">Not this, though it is longer</div></article>') == "The story."
        page = f'<body><div><p>The story is told here.</p></div><div class="{name}"><article>teaser</article></div></body>'
        assert H.main_text(page) == "The story is told here."
    assert H.main_text('<main><article>The story.</article><section id="comments">said someone</section></main>') == "The story."


def paragraphs(sizes):
    return [("".join(f"w{i}x{j} " for j in range(n)))[:n - 1] + "." for i, n in enumerate(sizes)]


def test_one_block_per_paragraph():
    for sizes in ((300, 320, 280, 310, 290, 305), (400, 380, 420, 60, 55, 390, 410, 405), (200,) * 12):
        texts = paragraphs(sizes)
        want = " ".join(" ".join(texts).split())
        for one in ("<div>{}</div>", "<div><p>{}</p></div>", "<div><div><p><b>{}</b></p></div></div>", "<tr><td>{}</td></tr>"):
            body = "".join(one.format(t) for t in texts)
            body = f"<table>{body}</table>" if "<td>" in one else body
            assert H.main_text(f"<html><body>{body}</body></html>") == want
            page = (f"<html><body><nav>{'<li><a href=/>x</a></li>' * 60}</nav><div><h1>Headline</h1>{body}</div>"
                    f"<div>{'<p><a href=/>More</a></p>' * 9}</div></body></html>")
            assert H.main_text(page) == "Headline " + want


def test_tags_of_dropped_parts():
    def first_line_tags(before):
        page = H._Page()
        page.feed(f"<body>{before}<p>The first paragraph.</p><p>And another.</p></body>")
        page.close()
        page.flush()
        return H._lines(page)[0][1]
    assert first_line_tags(f"<nav>{'<li><a href=/>x</a></li>' * 60}</nav>") <= first_line_tags("") + 2


def test_boilerplate_outside_the_blocks_stays_out():
    body = "".join(f"<div><p>{t}</p></div>" for t in paragraphs((300, 320, 280, 310)))
    page = f"<body><div><div><span>Log</span><div>in</div></div></div><div>{body}</div><div><p>Top</p><p>Up</p><p>Go</p></div></body>"
    assert H.main_text(page) == H.main_text(f"<body>{body}</body>") != ""


def test_names_of_menus_do_not_drop_paragraphs_of_an_article():
    """A name alone decides only where the text agrees: blocks of links and
    labels go, paragraphs stay."""
    long = "This paragraph has a good many words and not one link, so whatever its block is called it is no list of links. " * 2
    long = " ".join(long.split())
    for name in ("lead share", "menu", "side", "widget"):
        page = f'<body><article><h1>T</h1><div class="{name}"><p>{long}</p></div><p>End.</p></article></body>'
        assert H.main_text(page) == f"T {long} End."
        links = "".join(f'<a href="/{i}">Topic number {i} of the site</a> ' for i in range(12))
        page = f'<body><article><h1>T</h1><div class="{name}"><p>{links}</p><p>Share this</p></div><p>{long}</p></article></body>'
        assert H.main_text(page) == f"T {long}"
    # adverts and comments go however long they are
    for name in ("ad", "comments"):
        page = f'<body><article><h1>T</h1><div class="{name}"><p>{long}</p></div><p>End.</p></article></body>'
        assert H.main_text(page) == "T End."


def test_formulas_are_text():
    page = "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold.</p></article>"
    assert H.main_text(page) == "Let x=2 hold."
