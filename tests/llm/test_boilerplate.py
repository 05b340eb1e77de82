import html as entities
import random
import re

import pytest

from spindle.llm import boilerplate as bp
from spindle.llm import queries


def text_of(page):
    return [t for n, r, t in bp.blocks(page) if not n]


def test_blocks():
    page = """<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=x>menu</a></ul></nav><header>top</header>
      <div class="cookie-notice">we use</div><main><aside>side</aside><article><h1>Title &amp; more</h1><p>One<b> two</b><br>three<p>Four&nbsp;five
      <div class="ad">buy</div><form><input>name</form><script>if (a < b) "</p>"</script><p hidden>no</p><p>caf&eacute; &#8364;</p><!-- <p>out</p> -->
      <section id="comments"><article class="comment"><p>reader</p></article></section></article></main><footer>&copy; foot</footer></body>"""
    article, other, allowed, _ = bp._split(page)
    assert article == ["Title & more", "One two three", "Four five", "café €"]
    assert not any(allowed) and "menu" in other


@pytest.mark.parametrize("page,want", [
    ("", []), ("plain text", ["plain text"]), ("<p>a<p>b", ["a", "b"]), ("<div>a<div>b</div>c</div>", ["a", "b", "c"]), ("<p>x <!-- open", ["x"]),
    ("<script>var a", []), ("a < b and c > d", ["a < b and c > d"]), ("<p>a</b></i>b</p>", ["ab"]), ("<td>1</td><td>2</td>", ["1", "2"]), ("<P CLASS='Ads'>x</P>y", ["y"])])
def test_odd_markup(page, want):
    assert text_of(page) == want


def plain(streams):
    return "".join(f"<div>{s}</div>" for s in streams)


@pytest.mark.parametrize("sent", [bp.SENT_WINDOWS, 0])
def test_repeats_against_brute_force(spark, sent):
    """Without a named article, tokens in substrings of RUN tokens that stand on two distinct pages of a host go."""
    rnd = random.Random(5)
    common = [" ".join(rnd.choices([f"m{i}" for i in range(50)], k=rnd.randint(4, 15))) for _ in range(6)]
    pages = []
    for i in range(60):
        own = [" ".join(f"p{i}t{rnd.randrange(1000)}" for _ in range(rnd.randint(1, 30))) for _ in range(3)]
        parts = own + rnd.sample(common, 3)
        rnd.shuffle(parts)
        pages.append((i, f"http://h{i % 3}.org/{i}", plain(parts), "x"))
    pages += [(100, "http://h0.org/100", pages[0][2], "x"), (101, None, None, "x"), (102, "http://h0.org/e", "", "x")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, text string").repartition(4)
    got = {r.row_key: r.text for r in bp.extract(spark, frame, sent_windows=sent).collect()}
    tokens = {i: [t for b in re.findall("<div>(.*?)</div>", h or "") for t in b.split()] for i, _, h, _ in pages}
    where = {}
    for i, u, h, _ in pages:
        for k in range(len(tokens[i]) - bp.RUN + 1):
            where.setdefault((bp._host(u), tuple(tokens[i][k:k + bp.RUN])), set()).add(h)
    for i, u, h, _ in pages:
        gone = set()
        for k in range(len(tokens[i]) - bp.RUN + 1):
            if len(where[(bp._host(u), tuple(tokens[i][k:k + bp.RUN]))]) > 1:
                gone.update(range(k, k + bp.RUN))
        assert got[i].split() == [t for k, t in enumerate(tokens[i]) if k not in gone]
    assert any(len(got[i].split()) < len(tokens[i]) for i in range(60))


def test_table(spark):
    """Every page's article, its blocks joined (the markup of these pages is regular enough for a plain check)."""
    pages = {r.page_id: r for r in queries.table(spark, "/root/testdata/sf0.01", "pages").collect()}
    for r in queries.op9_host_suffix_array(spark, "/root/testdata/sf0.01").collect():
        inner = re.search("<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        parts = (" ".join(entities.unescape(re.sub("<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", inner))
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_empty(spark):
    assert bp.extract(spark, spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("page", [
    '<html class="no-js nav-open"><body><article><h1>Title</h1><p>Text</p></article></body></html>',
    '<html><body class="has-sidebar comments"><article><h1>Title</h1><p>Text</p></article></body></html>',
    '<article class="post has-comments"><h1>Title</h1><p>Text</p></article>',
    '<main id="search"><article class="sponsored"><div class="article-header"><h1>Title</h1></div><p>Text</p></article></main>',
    '<div class="wrapper sidebar-open"><main class="widget"><h1>Title</h1><p>Text</p></main></div>'])
def test_words_in_the_class_of_what_holds_the_article(page):
    assert bp._split(page)[0] == ["Title", "Text"]


@pytest.mark.parametrize("name", ["ad", "ad-slot-3", "Ads", "site-header", "sidebar", "x sidebar-left", "cookie-notice", "related-posts", "comments", "social_share"])
def test_furniture_by_class_or_id(name):
    for attribute in ("class", "id"):
        assert bp._split(f'<article><p>Text</p><div {attribute}="{name}">other</div></article>')[0] == ["Text"]


def alone(spark, *htmls):
    """The texts of pages that share no host."""
    frame = spark.createDataFrame([(i, f"http://h{i}.org/", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    return [r.text for r in bp.extract(spark, frame).orderBy("row_key").collect()]


BODY = " ".join(f"word{k}" for k in range(20))


def test_bodies_without_article_markup_stay(spark):
    """Words such as main or content in a menu's class make no container, and text outside a class's container is not lost."""
    assert alone(spark,
                 '<div id="main-menu">Home About</div><div class="text"><p>Body of the page</p></div>',
                 '<div class="content-sidebar">Home About</div><div class="text"><p>Body of the page</p></div>',
                 f'<div class="post"><p>Teaser</p></div><div class="x"><p>{BODY}</p><p>short</p></div>',
                 f'<div class="content">One</div><p>{BODY}</p><div class="content">Two</div>',
                 '<div class="entry-content"><p>Kept</p><div class="entry-footer">gone</div><div class="post-comments">gone</div></div>',
                 '<article><p>Kept</p><div class="entry-footer">gone</div><div class="post-comments">gone</div><ul class="main-nav"><li>gone</ul></article><p>outside of it</p>',
                 '<div class="postage">Only text</div>') == [
        "Body of the page", "Body of the page", f"Teaser\n{BODY}", f"One\n{BODY}\nTwo", "Kept", "Kept", "Only text"]


@pytest.mark.parametrize("unit", ["<b>x", "<div>x", "<b><p>x", "<i>x</u>", "<p><b>x</div>"])
def test_unclosed_tags_take_linear_time(unit):
    import time
    took = []
    for n in (20_000, 40_000):
        begun = time.time()
        bp.blocks(unit * n)
        took.append(time.time() - begun)
    assert took[1] < 3.5 * took[0] + 0.2
