import pytest
from farebox.llm.html_text import extract_text, main_text
from farebox.llm.queries import QUERIES

ARTICLE = "<article><h1>Title &amp; more</h1><p>First  paragraph\n of the text, long enough.<br>After a break<p>Short.<ul><li>one<li>two</ul></article>"
WANT = "Title & more\nFirst paragraph of the text, long enough. After a break\nShort.\none\ntwo"
AROUND = [
    ("", ""),
    ("<nav><ul><li><a href=x>Home</a></ul></nav>", "<footer>&copy; us</footer>"),
    ('<div class="ad">Buy this now, it is very cheap and very long to fill the line</div>', "<aside><p>Other stories that are long as well</p></aside>"),
    ("<script>var t='</p><article>no</article>';</script><style>p{}</style><!-- <p>hidden</p> -->", '<section id="comments"><p>I liked it a lot, dear author, really.</p></section>'),
    ('<div class="cookie-notice">We use cookies', "<form><label>Mail</label><input></form>"),
    ("<header><h2>Site</h2></header>", '<div style="display: none">secret</div><p role="contentinfo">imprint</p>'),
    ("<!DOCTYPE html><html><head><title>no</title><meta charset=utf-8></head><body>", "</body></html><!-- open"),
    ("<main>", "</main>"),
]


@pytest.mark.parametrize(("before", "after"), AROUND)
def test_only_the_article_stays(before, after):
    assert main_text(before + ARTICLE + after) == WANT


def test_without_an_article_the_densest_stretch_stays():
    menu = "".join(f"<li><a href=/{k}>Item number {k}</a>" for k in range(6))
    page = f"<ul>{menu}</ul><div><h1>Head</h1><p>Some text of a good length.</p><p>A <a href=x>link</a> in it.</p></div><ul>{menu}</ul><p>tiny</p>"
    assert main_text(page) == "Head\nSome text of a good length.\nA link in it."


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "<!-- x", "<script>", "</p></div>", "<p></p>", "<nav>only a menu</nav>"])
def test_pages_without_text(page):
    assert main_text(page) in ("", "<", "<p")


def test_stray_signs_and_depth():
    assert main_text("<p>1 < 2 and a<b> &lt;i&gt; &nbsp; &#x41;&unknown; x</p>") == "1 < 2 and a <i> A&unknown; x"
    assert main_text("<div>" * 3000 + "deep text here" + "</b>" * 3000) == "deep text here"
    assert len(main_text("<p>word" * 20000).split("\n")) == 20000


def test_table(spark):
    kind = "page_id long, url string, html string, text string, n int"
    rows = [(1, "u", ARTICLE, "x", 1), (1, "u", ARTICLE, "x", 1), (None, None, None, None, None), (2, "v", "", "x", 1)]
    pages = spark.createDataFrame(rows, kind)
    got = sorted(((x.page_id, x.text) for x in extract_text(pages, keep=("page_id", "text", "n")).collect()), key=repr)
    assert got == sorted([(1, WANT), (1, WANT), (None, ""), (2, "")], key=repr)
    assert extract_text(pages.limit(0)).collect() == []


def test_query(spark, data):
    for x in QUERIES["op8_html_text"](spark, data).collect():
        assert x.n_chars == len(x.text) > 0 and "<" not in x.text


@pytest.mark.parametrize("inset", ["<aside><p>x</p><p>y</p><p>z</p><p>w</p></aside>", "<form><p>x</p><p>y</p><p>z</p></form>", "<div class=ad><p>x<p>y<p>z</div>"])
def test_text_goes_on_after_lines_set_apart(inset):
    assert main_text(f"<p>A</p><p>B</p>{inset}<p>C</p><p>D</p>") == "A\nB\nC\nD"


def test_text_goes_on_after_a_list_of_links():
    links = "".join(f"<li><a href=/{k}>Link {k}</a>" for k in range(5))
    got = main_text(f"<p>A first part of the text.</p><ul>{links}</ul><p>The other part of it.</p><ul>{links}</ul><p>end</p>").split("\n")
    assert (got[0], got[-1]) == ("A first part of the text.", "The other part of it.")


def test_articles_only_extend_the_stretch():
    assert main_text("<main><h1>T</h1><p>intro</p><article><p>The long text of it.</p></article></main>") == "T\nintro\nThe long text of it."
    two = "<div><article><p>The first text of the page.</p></article><aside><p>x</p></aside><article><p>The second one.</p></article></div>"
    assert main_text(two) == "The first text of the page.\nThe second one."
    assert main_text("<p>Outside, and of some length.</p><article><p>Inside, and of some length.</p></article>").count("length") == 2


@pytest.mark.parametrize(
    "before",
    ["<html><head><title>t</title><body>", "<html><head><title>t<body>", "<select><option>one<option>two", "<object data=x>", "<noscript>", "<video src=x>", "<svg><path d=x>"],
)
def test_unclosed_elements_end_at_the_next_block(before):
    assert main_text(before + ARTICLE) == WANT
    assert main_text(before + ARTICLE + "<select><option>a</select><title>no</title>") == WANT


@pytest.mark.parametrize("name", ["script", "style", "textarea"])
def test_unclosed_scripts_take_the_rest(name):
    assert main_text(f"{ARTICLE}<{name}><p>not text</p>") == WANT


def test_names_set_no_article_apart():
    assert main_text('<article class="post promotion"><p>The text of it.</p></article><p>tiny</p>').startswith("The text of it.")
    assert main_text('<article><div class="entry-header"><h1>The Title</h1></div><p>Body of the text.</p></article>') == "The Title\nBody of the text."
    assert main_text('<article><header class="header banner"><h1>The Title</h1></header><p>Body.</p></article>') == "The Title\nBody."
    assert main_text('<article><p>An <span class="ad">ad</span> in words, <em id="share">shared</em>.</p></article>') == "An ad in words, shared."
    assert main_text('<main id="menu"><p>The text of it.</p></main>') == "The text of it."
    assert main_text('<div class="headerless"><p>The text of it.</p></div>') == "The text of it."


@pytest.mark.parametrize("name", ["ad", "site-header", "cookie-notice", "comments", "comment-list", "nav_menu", "x sidebar", "social-share-buttons", "related"])
def test_names_of_parts_beside_the_text(name):
    assert main_text(f'<div class="{name}"><p>Not a part of the text at all, whatever its length.</p></div>{ARTICLE}') == WANT


def test_formulas_and_fallback_text_stay_in_articles():
    inside = "<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds <canvas>drawn</canvas><noscript>plain</noscript>.</p>"
    assert main_text(f"<noscript>Switch it on</noscript><svg><text>logo</text></svg><article>{inside}</article>") == "So x=2 holds drawnplain."


def test_a_page_of_one_link():
    assert main_text('<p><a href="/x">All there is to read.</a></p>') == "All there is to read."


BROKEN = {
    "end tags of nothing": ("<div>" * 60_000 + "text" + "</b>" * 60_000, "text"),
    "quotes that never close": ('<p>text</p>' + '<a x="' * 150_000, None),
    "quotes that hide ends": ('<p>text</p>' + '<a x="' * 150_001 + ">", None),
    "odd quotes": ("<p>text</p>" + """<a x="'>""" * 100_000, None),
    "options": ("<p>text</p>" + "<option>" * 100_000 + "</option>", None),
    "titles": ("<p>text</p>" + "<title>" * 100_000, None),
    "comments": ("<p>text</p>" + "<!--" * 200_000, "text"),
    "nested articles": ("<article>" * 50_000 + "<p>text</p>" + "</article>" * 50_000, "text"),
    "paragraphs in divs": ("<div><p>" * 60_000 + "text", "text"),
    "ends in the wrong order": ("<div><section>" * 40_000 + "text" + "</div></section>" * 40_000, "text"),
}


@pytest.mark.parametrize("name", list(BROKEN))
def test_broken_markup_takes_seconds(name):
    import time

    page, want = BROKEN[name]
    began = time.process_time()
    got = main_text(page)
    assert time.process_time() - began < 6
    assert got == want if want else got.startswith("text")


def plain_lines(page):
    """Lines and weights of a page of flat blocks, cut by a plain pattern."""
    import re

    out = []
    for name, text in re.findall(r"<(p|h1|li)>(.*?)</\1>", page):
        links = "".join(re.findall(r"<a[^>]*>(.*?)</a>", text))
        bare = " ".join(re.sub(r"<[^>]*>", "", text).split())
        out.append((bare, len(bare.replace(" ", "")) - len(links.replace(" ", ""))))
    return out


def plain_walk(page):
    """Window sums and their surge and dive, as the docstring says them, over flat blocks."""
    lines = [x for x in plain_lines(page) if x[0]]
    sums = [sum(w for _, w in lines[max(0, i - 1) : i + 2]) for i in range(len(lines))]
    dense = [i for i, x in enumerate(sums) if x >= max(sums) / 4]
    first, last = dense[0], dense[-1]
    while first and sums[first - 1] > 0:
        first -= 1
    while last + 1 < len(sums) and sums[last + 1] > 0:
        last += 1
    kept = [i for i in range(first, last + 1)]
    while lines[kept[0]][1] == 0:
        kept.pop(0)
    while lines[kept[-1]][1] == 0:
        kept.pop()
    return "\n".join(lines[i][0] for i in kept)


def test_random_flat_pages_equal_a_plain_walk():
    import random

    draw = random.Random(11)
    for _ in range(300):
        blocks = []
        for _ in range(draw.randrange(1, 25)):
            words = " ".join("word" * draw.randrange(1, 3) for _ in range(draw.randrange(1, 20)))
            kind = draw.random()
            blocks.append(f'<li><a href="/{kind}">{words}</a></li>' if kind < 0.4 else f"<p>{words} <a href=x>more</a></p>" if kind < 0.6 else f"<p>{words}</p>")
        page = "".join(blocks) + "<p>some text</p>"
        assert main_text(page) == plain_walk(page)


def test_query_gives_the_article_of_every_page(spark, data):
    """The given pages hold one article each; its text is cut out here by plain patterns."""
    import html
    import re

    pages = {x.page_id: x.html for x in spark.read.parquet(f"{data}/pages.parquet").collect()}
    for x in QUERIES["op8_html_text"](spark, data).collect():
        (inner,) = re.findall(r"<article[^>]*>(.*?)</article>", pages[x.page_id], re.DOTALL)
        want = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br\s*/?>", " ", block))).split()) for block in re.split(r"</?(?:p|h\d|ul|ol|li|div|blockquote|pre|table|tr|section|figure|figcaption)\b[^>]*>", inner)]
        assert x.text == "\n".join(line for line in want if line)
