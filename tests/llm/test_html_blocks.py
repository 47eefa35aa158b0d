import html
import re

import pytest

from odometrix.llm.html_blocks import (
    default_tree,
    extract_pages,
    extract_text,
    fit_tree,
    flat_blocks,
    labelled_rows,
    predict,
)

TREE = default_tree()
ROWS = labelled_rows()


def test_tree_fits_its_table():
    assert all(predict(TREE, row[:-1]) == row[-1] for row in ROWS)
    assert fit_tree([(0,), (1,)], [0, 1]) == (0, 0.5, 0, 1) and fit_tree([(0,), (0,)], [1, 1]) == 1


def test_tree_holds_out_of_sample():
    # Leave-one-out over the labelled rows.
    hits = 0
    for k in range(len(ROWS)):
        rest = ROWS[:k] + ROWS[k + 1 :]
        tree = fit_tree([r[:-1] for r in rest], [r[-1] for r in rest])
        hits += predict(tree, ROWS[k][:-1]) == ROWS[k][-1]
    assert hits / len(ROWS) >= 0.85


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{a:"</p>"}</style></head><body class="page">
<header class="site-header"><h1>My Site</h1><nav><a href=/>Home</a> <a href=/x>About</a></nav></header>
<div id="cookie-notice">We use cookies to improve your experience on this site, as everybody does these days.</div>
<div class="wrap"><div id="content"><h2>A title of the article here</h2>
<p>This is a long paragraph of real text with many words, and <a href=x>one link</a> so it goes on &amp; on.</p>
<p>Second para&nbsp;graph   with
more words than the first one, it must stay in the text as well, because it &lt;is&gt; real.</p></div>
<aside><p>Sidebar text with quite a few words that one should not keep at all, however long it may be.</p></aside></div>
<form><label>Name</label><input><p>Please subscribe to our newsletter with your name and mail address today</p></form>
<section id="comments"><article class="comment"><p>Nice post, I liked reading it and will come back soon for more.</p>
</article></section><footer>Copyright 2024 by the owners of this site, all rights reserved</footer>
<script>var x = "<p>not text</p>";</script></body></html>"""


def test_unmarked_page():
    assert extract_text(PAGE, TREE).split("\n") == [
        "A title of the article here",
        "This is a long paragraph of real text with many words, and one link so it goes on & on.",
        "Second para graph with more words than the first one, it must stay in the text as well, because it <is> real.",
    ]


def test_broken_markup():
    assert extract_text(None, TREE) == "" and extract_text("", TREE) == ""
    assert extract_text("<article><p>kept <b>text<p>more</article", TREE) == "kept text\nmore"
    assert extract_text("<nav><ul><li><a>Home</a><article><h1>Title</h1><p>x &am", TREE) == "Title\nx &am"
    assert extract_text("<article>a<!-- unclosed <p>b</p>", TREE) == "a"
    assert extract_text('<article><p title="a>b">1 < 2 and 3 > 2</p></article>', TREE) == "1 < 2 and 3 > 2"
    assert extract_text("<article><p>" + "word " * 200_000 + "</p></article>", TREE).count("word") == 200_000
    assert len(flat_blocks("<div>" * 20_000 + "x")) == 1


def expected(page):
    """The article element of the tables' pages, cut at its block tags."""
    a = page.find("<article>")
    e = page.find("</article>")
    body = page[a + 9 : e if e >= 0 else len(page)] if a >= 0 else ""
    parts = (html.unescape(re.sub(r"<[^>]*>?", "", p.replace("<br>", " "))) for p in re.split(r"</?(?:p|h1)>", body))
    return "\n".join(t for t in (" ".join(p.split()) for p in parts) if t)


def test_pages_of_the_tables(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: expected(r.html) for r in pages.collect()}
    got = extract_pages(pages).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_nulls_repeats_and_extra_columns(spark):
    rows = [(1, "u", None, "x", 1), (2, None, PAGE, "y", 2), (2, None, PAGE, "y", 2), (None, "v", "", "z", 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = extract_pages(df).collect()
    assert sorted(r.n_chars for r in got) == [0, 0, *[len(extract_text(PAGE, TREE))] * 2]
    assert extract_pages(df.limit(0)).count() == 0


def test_article_tag_beats_class_words():
    text = "".join(f"<p>{'some plain words of a text ' * 6}</p>" for _ in range(3))
    want = "\n".join([" ".join(["some plain words of a text"] * 6)] * 3)
    for page in (
        f"<article class='post category-social'>{text}</article>",
        f"<main class='site-main no-sidebar'>{text}</main>",
        f"<div class='wrap has-sidebar'><article>{text}</article></div>",
        f"<div class='sidebar'><main>{text}</main></div>",
    ):
        assert extract_text(f"<body><nav><a>Home</a></nav>{page}<footer>the end of it</footer>", TREE) == want
    assert extract_text(f"<article>x y z<div class=related><article>{text}</article></div></article>", TREE) == "x y z"


def test_furniture_is_never_main_text():
    assert {(r[6], r[-1]) for r in ROWS} == {(0, 0), (1, 0), (1, 1), (2, 0), (2, 1)}
    sizes = (1, 12, 60, 100, 300)
    for words in sizes:
        for before in sizes:
            for after in (0, *sizes):
                for density in (0.0, 0.3, 1.0):
                    row = (words, density, before, 0.0, after, 0.0)
                    assert predict(TREE, (*row, 0)) == 0


def prose(paragraphs, words):
    return [" ".join(f"w{i}x{k}" for k in range(words)) for i in range(paragraphs)]


def tagged(lines, tag="p"):
    return "".join(f"<{tag}>{line}</{tag}>" for line in lines)


@pytest.mark.parametrize("words", [60, 100, 300])
@pytest.mark.parametrize(
    "part",
    ["<section class='comments'>{}</section>", "<div id='disqus_thread'>{}</div>", "<aside>{}</aside>",
     "<footer>{}</footer>", "<form>{}</form>", "<div class='cookie-notice'>{}</div>", "<div>{}</div>",
     "<div class='sidebar'>{}</div>", "<nav>{}</nav>", "<div class='comment'><p>only {}</p></div>"],
)
def test_long_furniture_beside_an_article_goes(part, words):
    text, other = prose(3, 80), tagged(prose(4, words))
    for page in (f"<article>{tagged(text)}</article>{part.format(other)}", f"{part.format(other)}<main>{tagged(text)}</main>"):
        assert extract_text(f"<html><body>{page}</body></html>", TREE).split("\n") == text


@pytest.mark.parametrize("words", [10, 12, 18, 25, 40, 120])
def test_unmarked_articles_return_whole(words):
    text = ["A heading of the article", *prose(20, words)]
    menu = "<ul>" + "".join(f"<li><a href=/{i}>item {i}</a></li>" for i in range(6)) + "</ul>"
    for page in (tagged(text), menu + tagged(text), menu + f"<div class=wrap>{tagged(text, 'div')}</div>"):
        assert extract_text(f"<body>{page}</body>", TREE).split("\n") == text


def test_linked_cards_go():
    card = "<a href=/{0}><div><h3>Card {0}</h3><p>with a teaser of some words to read</p></div></a>"
    cards = "".join(card.format(i) for i in range(8))
    text = prose(5, 50)
    assert extract_text(f"<body>{cards}{tagged(text)}</body>", TREE).split("\n") == text
    open_link = f"<body><p><a href=/x>open</p>{tagged(text)}</body>"  # a link without its end ends with its block
    assert extract_text(open_link, TREE).split("\n") == text


def test_all_text_features_are_used():
    def used(tree):
        return {tree[0]} | used(tree[2]) | used(tree[3]) if isinstance(tree, tuple) else set()

    assert used(TREE) == set(range(7))


def test_raw_tags_end_nothing_else():
    text = "<p>the first words of it</p>{}<p>and the rest of it</p>"
    want = "the first words of it\nand the rest of it"
    for tag in ("video-player", "svg-icon", "button-group", "select-box", "title-bar", "object", "video", "canvas"):
        assert extract_text(f"<article>{text.format(f'<{tag} a=1>')}</article>", TREE) == want
    for tag in ("button", "select", "svg", "math", "iframe"):  # unclosed, twice
        assert extract_text(f"<article>{text.format(f'<{tag}><{tag}>')}</article>", TREE) == want
        assert extract_text(f"<article>{text.format(f'<{tag}>gone</{tag}>')}</article>", TREE) == want
    assert extract_text(f"<article>{text.format('<script>')}</article>", TREE) == "the first words of it"
