import html
import re

import pytest

from activlake.llm.html_text import extract, main_text, measure, op8_html_text, parse, select

PAGES = {
    "": "",
    None: "",
    "plain text": "plain text",
    "<p>a<p>b": "a b",
    "<p>caf&eacute; &amp; &#x41;&am &unknown; x</p": "café & A&am &unknown; x",
    "<p>one\n\t two<br>three</p>": "one two three",
    "<p>foo<b>ba</b>r <a href=x>link</a></p>": "foobar link",
    "<p>x</p><script>var t='</p>';</script><style>p{}</style><!-- no --><p>y</p>": "x y",
    "<p title='a>b'>quoted</p><p title=\"open>odd</p>": "quoted odd",
    "<p>cut off <a href='x": "cut off",
    "<main><header><h1>Title</h1></header><p>Body text.</p></main><header>Site</header>": (
        "Title Body text."
    ),
    "<div class='cookie-notice'>We use cookies</div><div><p>Hello there</p></div>": "Hello there",
    "<div hidden>no</div><div role='navigation'>menu</div><p>yes</p>": "yes",
}


@pytest.mark.parametrize("page", list(PAGES))
def test_small_pages(page):
    assert main_text(page) == PAGES[page]


def test_article_without_its_surroundings():
    page = (
        "<html><body><nav><ul><li><a href=/>Home</a><li><a href=/b>Blog</a></ul></nav>"
        "<div id=sidebar><p>Popular posts and a long teaser text that is dense</p></div>"
        "<article><h1>On rain</h1><p>It rained for a whole day, and then some more.</p><p>Er.</p>"
        "<aside>Advert</aside><form>Sign up<input></form><ul><li>one</li><li>two</li></ul>"
        "<section class='comments'><p>First! What a long and thoughtful comment.</p></section>"
        "</article><footer>&copy; all of it</footer></body></html>"
    )
    wanted = "On rain It rained for a whole day, and then some more. Er. one two"
    assert main_text(page) == wanted


def test_density_selects_text_over_links_without_any_names():
    links = "".join(f"<li><a href=/{i}>item {i}</a></li>" for i in range(30))
    text = "".join(f"<p>Sentence number {i} of a story that goes on.</p>" for i in range(5))
    page = f"<body><div><ul>{links}</ul></div><div>{text}</div></body>"
    node, threshold = select(parse(page))
    assert threshold > 0
    assert main_text(page) == " ".join(
        f"Sentence number {i} of a story that goes on." for i in range(5)
    )


def test_deep_and_long_pages():
    assert main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert len(main_text("<p>" + "word " * 200_000)) == 999_999


def test_table_with_nulls_repeats_and_clashing_names(spark):
    rows = [(1, "<p>a</p>", "t"), (1, "<p>a</p>", "t"), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = sorted(map(tuple, extract(df, keep=("page_id",)).collect()), key=str)
    assert got == [(1, "a", 1), (1, "a", 1), (None, "", 0)]
    assert extract(df.limit(0), keep=("page_id",)).count() == 0


def test_driver_pages_equal_their_articles(spark, small):
    """The driver's pages mark the article, so its blocks can be cut out directly."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    for r in op8_html_text(spark, small).collect():
        found = re.search(r"<article>(.*?)(</article>|\Z)", pages[r.page_id], re.S)
        body = re.sub(r"<[^>]*\Z", "", found[1] if found else "")
        blocks = re.split(r"</?(?:p|h1|div)[^>]*>|<br>", body)
        texts = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks)
        assert r.text == " ".join(t for t in texts if t)
        assert r.n_chars == len(r.text)


def test_linked_blocks_of_the_article_stay():
    text = "".join(f"<p>Sentence number {i} of a story that goes on.</p>" for i in range(5))
    inner = (
        "<h1><a href=/t>Title</a></h1>" + text + "<h2><a href=#s>Section</a></h2>"
        "<p><a href=/p>Linked paragraph</a></p><table><tr><td><a href=/c>Cell</a></td></tr></table>"
        "<ul><li><a href=/1>First source</a></li><li><a href=/2>Second source</a></li></ul>"
    )
    said = " ".join(f"Sentence number {i} of a story that goes on." for i in range(5))
    wanted = f"Title {said} Section Linked paragraph Cell First source Second source"
    menu = "<nav><a href=/>Home</a></nav>"
    for tag in ("article", "main"):
        assert main_text(f"<body>{menu}<{tag}>{inner}</{tag}></body>") == wanted
    plain = "<h1><a href=/t>Title</a></h1>" + text + "<p><a href=/p>Linked paragraph</a></p>"
    assert main_text(f"<body><div>{plain}</div></body>") == f"Title {said} Linked paragraph"


STORY = "".join(f"<p>Sentence number {i} of a story that goes on.</p>" for i in range(5))
SAID = " ".join(f"Sentence number {i} of a story that goes on." for i in range(5))


@pytest.mark.parametrize(
    "around",
    ["div class='layout has-sidebar'", "div class='page with-nav'", "div class='social-news'"]
    + ["div id='discussion-page'", "form action=/", "div class=widget", "div role=form"],
)
@pytest.mark.parametrize("holder", ["article", "main", "div"])
def test_hints_around_the_article_do_not_drop_it(around, holder):
    side = "<div class=sidebar><p>Popular</p></div><div class='comment-list'><p>First!</p></div>"
    close = around.split()[0]
    page = f"<body><{around}>{side}<{holder}>{STORY}</{holder}></{close}></body>"
    assert main_text(page) == SAID


def test_hints_beside_the_article_still_drop():
    long = "<p>What a long and thoughtful comment, longer than anything.</p>" * 20
    for side in ("class=comments", "class='comments-area'", "id=related", "class='site-footer'"):
        extra = f"<div {side}><article><p>Short.</p></article>{long}</div>"
        assert main_text(f"<body><article>{STORY}</article>{extra}</body>") == SAID


def test_sibling_articles_are_all_returned_in_page_order():
    first = "Part one is a first text that goes on for a while, as such parts of stories mostly do."
    one, two = f"<article><p>{first}</p></article>", f"<article>{STORY}</article>"
    page = f"<body><nav><a href=/>Home</a></nav>{one}<div class=ads>Buy</div>{two}</body>"
    assert main_text(page) == f"{first} {SAID}"


@pytest.mark.parametrize("named", ["post has-comments", "comments-closed", "entry no-comments", "comment"])
def test_an_article_that_tells_about_its_comments_stays(named):
    page = f"<body><nav><a href=/>Home</a></nav><article class='{named}'>{STORY}</article></body>"
    assert main_text(page) == SAID


@pytest.mark.parametrize("named", ["user-comments", "reader-comments", "comments-2", "story_comments_list"])
@pytest.mark.parametrize("tag", ["div", "section", "article"])
def test_reader_comments_go_whatever_else_their_name_says(named, tag):
    long = "<p>What a long and thoughtful comment, longer than anything.</p>" * 20
    inside = f"<body><article>{STORY}<{tag} class='{named}'>{long}</{tag}></article></body>"
    beside = f"<body><article>{STORY}</article><{tag} id='{named}'>{long}</{tag}></body>"
    nested = f"<body><article>{STORY}<div class='{named}'><article>{long}</article></div></article></body>"
    assert main_text(inside) == main_text(beside) == main_text(nested) == SAID


def test_articles_in_two_wrappers_and_short_ones_are_returned():
    short = "<article><p>Short.</p></article>"
    page = f"<body><div><article>{STORY}</article></div><div class=x>{short}</div></body>"
    assert main_text(page) == f"{SAID} Short."
    page = f"<body><div>{short}</div><section><div><article>{STORY}</article></div></section></body>"
    assert main_text(page) == f"Short. {SAID}"


def test_density_decides_where_articles_hold_little():
    teaser = "<article><p>Read on.</p></article>"
    assert main_text(f"<body>{teaser}<div>{STORY}</div></body>") == SAID
    enough = "<article><p>A short article, though it is no teaser: it has a text of its own.</p></article>"
    assert main_text(f"<body>{enough}<div><p>{'Advert text. ' * 8}</p></div></body>").startswith("A short")


def brute(node):
    """Characters, tags and both within links of every element, from the tree alone."""
    chars = len("".join(p for p in node["text"]).replace(" ", ""))
    total = [chars, 0, chars if node["tag"] == "a" else 0, 0]
    for child in node["children"]:
        own = brute(child)
        total[0] += own[0]
        total[1] += own[1] + 1
        total[2] += own[0] if node["tag"] == "a" else own[2]
        total[3] += own[3] + (child["tag"] == "a")
    node["counts"] = total
    return total


def test_densities_against_the_formula():
    """A small DOM, its counts taken by recursion and the formula written out."""
    from html.parser import HTMLParser
    from math import e, log

    page = (
        "<body><div><a>Home</a><a>News and more</a></div><div><p>One paragraph of plain words.</p>"
        "<p>Another, with <a>a link</a> and <b>bold</b> words.</p><div><p>Deep.</p></div></div></body>"
    )
    root = {"tag": "body", "text": [], "children": []}
    stack = [root]

    class Tree(HTMLParser):
        def handle_starttag(self, tag, attributes):
            if tag != "body":
                stack[-1]["children"].append({"tag": tag, "text": [], "children": []})
                stack.append(stack[-1]["children"][-1])

        def handle_endtag(self, tag):
            if tag != "body":
                stack.pop()

        def handle_data(self, data):
            stack[-1]["text"].append(data)

    Tree().feed(page)
    brute(root)
    c_body, _, lc_body, _ = root["counts"]

    def density(node):
        c, t, lc, lt = node["counts"]
        base = log(c * lc / max(c - lc, 1) + lc_body * c / c_body + e)
        return c / max(t, 1) * max(log(c * max(t, 1) / (max(lc, 1) * max(lt, 1))), 0) / base

    def blocks(node):
        return [c for c in node["children"] if c["tag"] not in ("a", "b")]

    def walk(mine, node):
        assert (mine.tag, mine.chars, mine.tags) == (node["tag"], node["counts"][0], node["counts"][1])
        assert (mine.link_chars, mine.link_tags) == tuple(node["counts"][2:])
        assert mine.density == pytest.approx(density(node))
        inner = [density(x) for x in blocks(node)]
        assert mine.total == pytest.approx(sum(inner) or density(node))
        for own, other in zip(mine.children(), blocks(node), strict=True):
            walk(own, other)

    tree = parse(page)
    measure(tree)
    walk(tree, root)
    assert main_text(page) == "One paragraph of plain words. Another, with a link and bold words. Deep."
