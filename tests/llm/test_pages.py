import html
import math
import re

import pytest
from pyspark.sql import functions as F

from rankflow.llm import pages
from rankflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
PROSE = "A long enough sentence of the article, with some words in it. " * 4


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("no markup &amp; a < b", "no markup & a < b"),
        ("<p>Alone", "Alone"),
        ("<div>x<script>var a='<p>no</p>';</script>y<style>p{}</style></div>", "x y"),
        ("<p title='a>b'>quo<i>te</i>d&nbsp;&#233;\n\t z<br>w</p>", "quoted é z w"),
        ("<article><h1>T</h1><p>a<p>b<ul><li>c<li>d</ul><form><p>no</p></form><aside>no</aside></article><footer>no</footer>", "T a b c d"),
        ("<article><h1>T</h1><p><b>bold<br><p>next</p></article>", "T bold next"),
        ("<nav><ul><li><a href=/a>menu</a></ul></nav><main><p>one</p><div class='ad box'>buy</div><p>two</p></main>", "one two"),
        ("<main><p>one</p><section id=comments><p>reader</p></section></main><div class=cookie-notice>ok?</div>", "one"),
        ("<!-- a --><body><header>Site</header><main><header><h1>H</h1></header><p>x</p></main><!-- open", "H x"),
        ("<script>never closed <p>no", ""),
        ("<nav>open <div>menu</div></nav></nav><p>after</p>", "after"),
        ("<p>a</p><div hidden>no</div><div style='display: none'>no</div><div role=navigation>no</div><p>b</p>", "a b"),
    ],
)
def test_pages(source, text):
    assert pages.main_text(source) == text


def test_densest_container_wins_over_link_lists():
    links = "".join(f"<li><a href=/{i}>Some other story {i}</a></li>" for i in range(30))
    body = "".join(f"<p>{PROSE}{i}</p>" for i in range(6))
    source = f"<body><div><ul>{links}</ul></div><div><div>{body}<p>Of.</p></div></div><div>Short line</div></body>"
    assert pages.main_text(source) == " ".join([*(f"{PROSE}{i}" for i in range(6)), "Of."])


FIVE = "".join(f"<p>{PROSE}{i}</p>" for i in range(5))
PLAIN = " ".join(f"{PROSE}{i}" for i in range(5))


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (f"<article><h1>Title</h1><div>{FIVE}</div></article>", f"Title {PLAIN}"),
        (f"<article>Lead text, <b>bold</b> and <a href=/>linked</a>.<div>{FIVE}</div><pre>code</pre></article>", f"Lead text, bold and linked. {PLAIN} code"),
        (f"<article><blockquote>Said</blockquote><div>{FIVE}</div><div>End</div></article>", f"Said {PLAIN} End"),
        (f"<article><header><h1>T</h1><p>By A</p></header><div>{FIVE}</div><div><a href=/>more</a></div></article>", f"T By A {PLAIN}"),
        (f"<div><div class='site-content right-sidebar'><div class=elementor-widget>{FIVE}</div></div></div>", PLAIN),
        (f"<div class='page has-sidebar'>{FIVE}</div><div class='sidebar'>other</div>", PLAIN),
        (f"<form id=aspnet><nav>menu</nav><main>{FIVE}</main><div class=footer>foot</div></form>", PLAIN),
        (f"<div class=widget><article>{FIVE}</article></div><form>search</form>", PLAIN),
        (f"<form>{FIVE}</form><div class=ad>buy</div>", PLAIN),
        (f"<article>{FIVE}</article><div class=comments><article>{FIVE}{FIVE}</article></div>", PLAIN),
    ],
)
def test_ordinary_page_shapes(source, text):
    assert pages.main_text(source) == " ".join(text.split())


def paragraphs(n, name):
    return "".join(f"<p>{PROSE}{name}{k}</p>" for k in range(n)), " ".join(f"{PROSE}{name}{k}" for k in range(n))


@pytest.mark.parametrize("comments", [1, 4, 5, 40])
@pytest.mark.parametrize("tag", ["article", "div"])
@pytest.mark.parametrize("name", ["post-comments", "commentlist", "comments"])
def test_comments_never_take_the_article(comments, tag, name):
    article, text = paragraphs(4, "a")
    said, _ = paragraphs(comments, "c")
    assert pages.main_text(f"<body><{tag}>{article}</{tag}><div class='{name}'>{said}</div></body>") == text


@pytest.mark.parametrize(
    "name",
    "ad-wrapper advert-box google-ad newsletter-box related-articles share-bar post-comments commentlist article-comments sidebar-left "
    "cookie-bar promo-box site-notice".split(),
)
def test_compound_names_inside_an_article(name):
    assert pages.main_text(f"<article>{FIVE}<div class='x {name}'><p>{PROSE}other</p></div><p>End.</p></article>") == f"{PLAIN} End."
    assert pages.main_text(f"<article>{FIVE}<p class='{name}'>End.</p></article>") == (f"{PLAIN} End." if "-" in name else PLAIN)


@pytest.mark.parametrize("name", ["has-sidebar", "left-sidebar", "elementor-widget", "menu-item", "social-science"])
def test_names_of_layout_and_topics_stay(name):
    assert pages.main_text(f"<article>{FIVE}<div class='{name}'>End.</div></article>") == f"{PLAIN} End."


def test_sections_of_one_article():
    long, text = paragraphs(4, "a")
    source = f"<body><div><section>{long}</section><section><h2>Two</h2><p>{PROSE}b</p></section><section><p>Short.</p></section></div></body>"
    assert pages.main_text(source) == " ".join(f"{text} Two {PROSE}b Short.".split())


def test_linked_paragraphs_stay_and_link_lists_go():
    links = "".join(f"<li><a href=/{i}>Other story {i}</a></li>" for i in range(8))
    bar = "<p><a href=/>one</a> <a href=/>two</a> <a href=/>three</a></p>"
    source = f"<article>{FIVE}<p><a href=/>All of this is a link.</a></p><ul>{links}</ul>{bar}<p>End.</p></article>"
    assert pages.main_text(source) == f"{PLAIN} All of this is a link. End."


def test_articles_are_preferred_to_denser_text_elsewhere():
    article, text = paragraphs(3, "a")
    other, _ = paragraphs(6, "x")
    assert pages.main_text(f"<body><article>{article}</article><div>{other}</div></body>").startswith(text)


def slow_densities(tree, share, total):
    """Characters, tags, link characters and links of a tree of (tag, children), by recursion, with the density of each."""
    def figures(node):
        if isinstance(node, str):
            return len(node.strip()), 0, 0, 0
        tag, children = node
        found = [figures(c) for c in children]
        chars = sum(f[0] for f in found)
        tags = sum(f[1] + (not isinstance(c, str)) for f, c in zip(found, children, strict=True))
        linked = chars if tag == "a" else sum(f[2] for f in found)
        return chars, tags, linked, sum(f[3] for f in found) + (tag == "a")

    def density(chars, tags, linked, links):
        if not chars:
            return 0.0
        log_base = math.log(math.log(chars / max(chars - linked, 1) * linked + share * chars + math.e))
        ratio = chars / max(linked, 1) * max(tags, 1) / max(links, 1)
        return chars / max(tags, 1) * math.log(max(ratio, 1.0)) / log_base if log_base > math.log(1.0001) else None

    out = []

    def walk(node):
        if not isinstance(node, str):
            out.append((figures(node), density(*figures(node))))
            for child in node[1]:
                walk(child)

    walk(tree)
    return out


def test_densities_of_random_trees(rng):
    def tree(depth):
        if depth == 0 or rng.random() < 0.3:
            return " ".join(rng.choice(["word", "longer word", "x"]) for _ in range(rng.randint(1, 30)))
        return rng.choice(["div", "section", "span", "b", "a"]), [tree(depth - 1) for _ in range(rng.randint(0, 4))]

    def source(node):
        return node if isinstance(node, str) else f"<{node[0]}>{''.join(map(source, node[1]))}</{node[0]}>"

    def only_outer_links(node, inside=False):
        if isinstance(node, str):
            return node
        tag = "b" if node[0] == "a" and inside else node[0]
        return tag, [only_outer_links(c, inside or tag == "a") for c in node[1]]

    compared = 0
    for _ in range(200):
        body = only_outer_links(("body", [tree(4) for _ in range(3)]))
        page = pages.Page("".join(map(source, body[1])))
        merged = merge_texts(body)
        density, chars, linked, links = pages._densities(page)
        total, _, link_chars, _ = slow_densities(merged, 0, 1)[0][0]
        expected = slow_densities(merged, link_chars / total if total else 0, total)
        assert len(expected) == len(page.tags)
        for i, ((c, _, lc, k), d) in enumerate(expected):
            assert (chars[i], linked[i], links[i]) == (c, lc, k)
            if d is not None:
                compared += 1
                assert density[i] == pytest.approx(d)
    assert compared > 2000


def merge_texts(node):
    """Neighbouring texts are one text, as in a page."""
    if isinstance(node, str):
        return node
    merged = []
    for child in map(merge_texts, node[1]):
        if merged and isinstance(child, str) and isinstance(merged[-1], str):
            merged[-1] += child
        else:
            merged.append(child)
    return node[0], merged


def test_article_in_several_sections():
    body = "".join(f"<div><p>{PROSE}{i}a</p><p>{PROSE}{i}b</p></div>" for i in range(4))
    assert pages.main_text(f"<body><div>{body}</div></body>") == " ".join(f"{PROSE}{i}{x}" for i in range(4) for x in "ab")


def test_deep_and_long_pages():
    assert pages.main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert len(pages.main_text("<article>" + f"<p>{PROSE}</p>" * 20_000)) == 20_000 * len(PROSE) - 1
    assert pages.main_text("<a " * 3000 + '"' * 3000) is not None


def test_rows(spark):
    rows = [(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (2, None, None), (None, "v", "")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit(1)).withColumn("key", F.lit(1))
    got = pages.extract(df).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, [(1, "u", "a", 1), (1, "u", "a", 1), (2, None, "", 0), (None, "v", "", 0)]))
    assert pages.extract(df.limit(0)).collect() == []


def test_query(spark):
    """The pages' articles, cut out by their known frame."""
    sources = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    for r in QUERIES["op4_page_text"](spark, FOLDER).collect():
        article = re.search(r"<article>(.*?)(</article>|<footer>)", sources[r.page_id], re.S)[1]
        plain = html.unescape(re.sub(r"<[^>]+>", "", re.sub(r"</?(p|h1|li|br)[^>]*>", " ", article)))
        assert r.text == " ".join(plain.split()) and r.n_chars == len(r.text)
