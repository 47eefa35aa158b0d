"""Main-text extraction from HTML by a decision tree over flat text blocks.

A page is cut into flat text blocks at block-level tags. Each block has its
words and link density (share of its words inside links), those of its
neighbours, the zone it stands in (article, page furniture, or neither, from
its ancestors' tags, roles and class or id words) and whether the page marks an
article at all. A decision tree (CART, Gini) trained on the small labelled tables
``LABELLED`` and ``LABELLED_PAGES`` tells main text from the rest. Furniture by tag
or name (menus, headers, footers, asides, notices, forms, comments) is never main
text, however long; beside a marked article no other text is. On pages that mark
none, words and link densities of a block and its neighbours decide.

Pages are independent rows, handled one at a time inside Arrow batches; nothing
is shuffled and no html is cut.

Defined results: null or empty html gives the empty text; broken markup never
fails (unclosed tags end with the page, an unfinished tag at the end is
dropped); repeated pages give repeated rows; an empty table gives none; other
columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odometrix.llm.common import read_table, ship_package

_RAW = "script|style|noscript|template|iframe|svg|math|object|canvas|video|audio|select|textarea|title|button"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})(?=[\s/>])(?P<rawattrs>[^>]*)>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[/!?a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in _RAW.split("|")}
_RAW_TO_END = frozenset(("script", "style", "title"))  # without an end tag, these take the rest of the page
_LINK = re.compile(r"<(/?)a(?=[\s/>])", re.I)
_NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

# Tags that run on inside a block; every other tag ends the block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

# Zones. Furniture inside an article is furniture; an article inside weak
# furniture (an unclosed menu, a header) is an article. An article tag also beats
# class words on itself and on what wraps it, unless they name comments.
NEITHER, ARTICLE, FURNITURE = 0, 1, 2
ARTICLE_TAGS = frozenset(("article", "main"))
WEAK_TAGS = frozenset(("nav", "header", "menu", "head"))
STRONG_TAGS = frozenset(("footer", "aside", "form", "dialog", "fieldset"))
ARTICLE_WORDS = frozenset(("article", "main", "articlebody"))
CONTENT_WORDS = frozenset("article post entry content story main body text articlebody".split())
WEAK_WORDS = frozenset("nav navbar navigation menu header masthead topbar breadcrumb breadcrumbs".split())
STRONG_WORDS = frozenset(
    "ad ads adbox adslot adunit advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "sidebar aside complementary footer contentinfo comment comments commentlist disqus respond reply replies "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay dialog newsletter subscribe "
    "subscription signup login search share sharing social related recommended recommendations widget widgets "
    "toolbar pagination pager copyright legal disclaimer skip teaser teasers".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond reply replies".split())
# Parts that leave a compound name what its other parts say (site-footer, ad-box).
PLAIN_WORDS = frozenset(
    "site page main top bottom left right primary secondary global mobile desktop area box bar block section wrap "
    "wrapper container inner outer list item items link links button buttons icon icons group row col column panel "
    "holder posts articles stories entries news js the 1 2 3".split()
) | CONTENT_WORDS
# Kinds of class furniture: an article tag inside lifts the first one only.
WEAK, LIFTED, FIXED = 0, 1, 2

FEATURES = ("words", "link_density", "prev_words", "prev_link_density", "next_words", "next_link_density", "place")

# Labelled table: words and link density of a block, the one before and the next,
# its zone (0 neither, 1 article, 2 furniture), whether the page has an article,
# then 1 for main text.
LABELLED = (
    # pages that mark an article: its blocks, short or long, linked or not
    (9, 0.0, 4, 0.0, 60, 0.0, 1, 1, 1), (62, 0.0, 9, 0.0, 48, 0.02, 1, 1, 1), (48, 0.02, 62, 0.0, 3, 0.0, 1, 1, 1),
    (3, 0.0, 48, 0.02, 80, 0.0, 1, 1, 1), (80, 0.0, 3, 0.0, 12, 0.5, 1, 1, 1), (1, 0.0, 12, 1.0, 7, 0.0, 1, 1, 1),
    (12, 0.6, 80, 0.0, 30, 0.0, 1, 1, 1), (2, 1.0, 30, 0.0, 25, 0.1, 1, 1, 1), (140, 0.05, 2, 1.0, 5, 0.0, 1, 1, 1),
    (5, 0.0, 140, 0.05, 9, 0.4, 1, 1, 1), (7, 0.0, 1, 0.0, 0, 0.0, 1, 1, 1), (22, 0.9, 7, 0.0, 40, 0.0, 1, 1, 1),
    (30, 0.0, 20, 0.0, 40, 0.7, 1, 1, 1), (4, 0.0, 3, 1.0, 50, 0.8, 1, 1, 1), (2, 1.0, 30, 0.5, 45, 0.6, 1, 1, 1),
    (25, 0.0, 0, 0.0, 18, 1.0, 1, 1, 1), (3, 0.0, 2, 1.0, 6, 1.0, 1, 1, 1), (6, 0.2, 8, 0.0, 2, 0.0, 1, 1, 1),
    # their furniture: menus, adverts, notices, asides, forms, comments, footers
    (1, 1.0, 0, 0.0, 1, 1.0, 2, 1, 0), (1, 1.0, 1, 1.0, 1, 1.0, 2, 1, 0), (1, 1.0, 1, 1.0, 14, 0.0, 2, 1, 0),
    (14, 0.0, 1, 1.0, 9, 0.0, 2, 1, 0), (35, 0.0, 60, 0.0, 41, 0.0, 2, 1, 0), (41, 0.0, 35, 0.0, 50, 0.0, 2, 1, 0),
    (50, 0.0, 41, 0.0, 11, 0.0, 2, 1, 0), (11, 0.0, 48, 0.0, 0, 0.0, 2, 1, 0), (90, 0.1, 5, 0.0, 3, 0.0, 2, 1, 0),
    (3, 0.0, 90, 0.1, 26, 0.0, 2, 1, 0), (26, 0.0, 3, 0.0, 5, 1.0, 2, 1, 0), (5, 1.0, 26, 0.0, 0, 0.0, 2, 1, 0),
    # unmarked blocks beside a marked article
    (16, 0.0, 1, 1.0, 9, 0.0, 0, 1, 0), (45, 0.0, 70, 0.0, 4, 0.0, 0, 1, 0), (4, 0.5, 45, 0.0, 0, 0.0, 0, 1, 0),
    (70, 0.1, 5, 1.0, 12, 0.0, 0, 1, 0), (2, 1.0, 70, 0.1, 2, 1.0, 0, 1, 0),
    (30, 0.0, 1, 1.0, 60, 0.0, 0, 1, 0), (8, 0.0, 0, 0.0, 40, 0.0, 0, 1, 0), (12, 0.0, 20, 0.0, 25, 0.0, 0, 1, 0),
    (60, 0.0, 0, 0.0, 90, 0.0, 0, 1, 0), (3, 1.0, 2, 1.0, 30, 0.0, 0, 1, 0), (44, 0.0, 18, 0.0, 33, 0.1, 0, 1, 0),
    # pages that mark nothing: running text
    (58, 0.0, 8, 0.0, 64, 0.0, 0, 0, 1), (64, 0.03, 58, 0.0, 19, 0.0, 0, 0, 1), (19, 0.0, 64, 0.03, 71, 0.0, 0, 0, 1),
    (33, 0.1, 71, 0.0, 40, 0.0, 0, 0, 1), (8, 0.0, 2, 0.0, 58, 0.0, 0, 0, 1), (5, 0.0, 33, 0.0, 42, 0.0, 0, 0, 1),
    (11, 0.0, 47, 0.0, 36, 0.0, 0, 0, 1), (90, 0.25, 20, 0.0, 30, 0.0, 0, 0, 1), (24, 0.0, 3, 1.0, 55, 0.0, 0, 0, 1),
    (28, 0.0, 90, 0.1, 2, 1.0, 0, 0, 1), (6, 0.0, 28, 0.0, 31, 0.0, 0, 0, 1), (40, 0.0, 2, 1.0, 3, 1.0, 0, 0, 1),
    # pages that mark nothing: links, labels, short lines among links
    (1, 1.0, 0, 0.0, 2, 1.0, 0, 0, 0), (2, 1.0, 1, 1.0, 3, 1.0, 0, 0, 0), (3, 1.0, 2, 1.0, 9, 0.0, 0, 0, 0),
    (25, 0.8, 4, 0.0, 5, 1.0, 0, 0, 0), (12, 0.7, 60, 0.0, 3, 1.0, 0, 0, 0), (5, 0.0, 3, 1.0, 2, 1.0, 0, 0, 0),
    (4, 0.0, 2, 1.0, 2, 0.0, 0, 0, 0), (6, 0.0, 28, 0.0, 0, 0.0, 0, 0, 0), (9, 0.4, 40, 0.0, 3, 1.0, 0, 0, 0),
    (40, 0.6, 6, 1.0, 50, 0.7, 0, 0, 0), (3, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0), (2, 0.0, 6, 0.5, 4, 0.0, 0, 0, 0),
    (2, 1.0, 1, 1.0, 40, 0.0, 0, 0, 0), (6, 0.9, 3, 1.0, 55, 0.0, 0, 0, 0), (3, 1.0, 30, 0.0, 40, 0.0, 0, 0, 0),
    # link lists inside an article: contents, tags, shares, further reading
    (1, 1.0, 1, 1.0, 2, 1.0, 1, 1, 0), (4, 1.0, 3, 1.0, 5, 1.0, 1, 1, 0), (7, 1.0, 6, 1.0, 8, 1.0, 1, 1, 0),
    (2, 1.0, 2, 1.0, 1, 1.0, 1, 1, 0), (9, 1.0, 7, 1.0, 4, 1.0, 1, 1, 0), (5, 1.0, 8, 1.0, 6, 1.0, 1, 1, 0),
    (2, 1.0, 3, 1.0, 40, 0.0, 1, 1, 0), (6, 1.0, 4, 1.0, 22, 0.0, 1, 1, 0), (3, 1.0, 5, 1.0, 0, 0.0, 1, 1, 0),
    (8, 1.0, 6, 1.0, 60, 0.0, 1, 1, 0), (2, 1.0, 40, 0.0, 3, 1.0, 1, 1, 0), (5, 1.0, 60, 0.0, 4, 1.0, 1, 1, 0),
    (1, 1.0, 22, 0.0, 2, 1.0, 1, 1, 0),
    # plain lines of an article, and furniture before running text
    (18, 0.0, 9, 0.0, 7, 0.0, 1, 1, 1), (40, 0.0, 12, 0.0, 6, 0.0, 1, 1, 1), (33, 0.0, 25, 0.0, 10, 0.0, 1, 1, 1),
    (10, 0.0, 22, 0.0, 14, 0.0, 1, 1, 1), (14, 0.1, 5, 0.0, 33, 0.0, 1, 1, 1), (52, 0.0, 31, 0.0, 18, 0.0, 1, 1, 1),
    (5, 0.0, 3, 0.0, 90, 0.0, 2, 1, 0), (16, 0.0, 8, 0.0, 110, 0.0, 2, 1, 0), (1, 1.0, 2, 1.0, 95, 0.0, 2, 1, 0),
    (30, 0.0, 14, 0.0, 70, 0.0, 2, 0, 0), (9, 0.0, 88, 0.0, 92, 0.0, 2, 1, 0), (20, 0.0, 100, 0.0, 75, 0.0, 2, 0, 0),
    # blocks beside a marked article, however long
    (85, 0.0, 90, 0.0, 76, 0.02, 0, 1, 0), (110, 0.03, 74, 0.0, 95, 0.0, 0, 1, 0), (130, 0.05, 88, 0.0, 120, 0.0, 0, 1, 0),
    (40, 0.0, 12, 0.0, 0, 0.0, 0, 1, 0), (60, 0.0, 30, 0.0, 2, 1.0, 0, 1, 0),
    # long furniture: comments, asides, footers, notices and forms in paragraphs
    (140, 0.0, 120, 0.0, 95, 0.02, 2, 1, 0), (95, 0.02, 140, 0.0, 130, 0.0, 2, 1, 0), (300, 0.0, 200, 0.0, 250, 0.0, 2, 1, 0),
    (104, 0.0, 118, 0.0, 99, 0.0, 2, 0, 0), (150, 0.03, 104, 0.0, 125, 0.0, 2, 0, 0), (250, 0.0, 60, 0.0, 0, 0.0, 2, 0, 0),
    # short furniture and labels after or between running text
    (6, 0.0, 140, 0.0, 9, 0.0, 2, 1, 0), (14, 0.0, 120, 0.0, 3, 1.0, 2, 1, 0), (22, 0.2, 95, 0.0, 18, 0.0, 2, 1, 0),
    (12, 0.0, 85, 0.0, 100, 0.0, 2, 1, 0), (3, 1.0, 130, 0.0, 2, 1.0, 2, 0, 0), (25, 0.0, 110, 0.0, 6, 0.0, 2, 0, 0),
    (75, 0.0, 10, 0.0, 40, 0.0, 2, 1, 0), (120, 0.0, 15, 0.0, 28, 0.0, 2, 1, 0), (85, 0.0, 6, 0.0, 50, 0.0, 2, 0, 0),
    (64, 0.0, 50, 0.0, 70, 0.0, 2, 1, 0), (82, 0.0, 70, 0.0, 45, 0.0, 2, 1, 0), (130, 0.0, 30, 0.0, 120, 0.0, 2, 1, 0),
    (95, 0.0, 20, 0.0, 40, 0.0, 0, 1, 0), (66, 0.0, 12, 0.0, 90, 0.0, 0, 1, 0), (88, 0.0, 40, 0.0, 18, 0.0, 0, 1, 0),
    (10, 0.0, 120, 0.0, 4, 1.0, 0, 1, 0), (28, 0.0, 90, 0.0, 5, 0.0, 0, 1, 0),
    (18, 0.5, 85, 0.0, 90, 0.0, 0, 1, 0), (90, 0.0, 8, 0.0, 14, 0.0, 0, 1, 0), (80, 0.0, 6, 1.0, 12, 0.0, 0, 1, 0),
    # links of an article between its running text
    (2, 1.0, 60, 0.0, 8, 0.0, 1, 1, 1), (8, 1.0, 75, 0.0, 12, 0.0, 1, 1, 1), (3, 0.5, 40, 0.0, 6, 0.1, 1, 1, 1),
    (15, 0.6, 22, 0.0, 9, 0.0, 1, 1, 1), (1, 1.0, 7, 0.0, 5, 0.0, 1, 1, 1), (4, 1.0, 12, 0.0, 0, 0.0, 1, 1, 1),
    (6, 1.0, 9, 0.2, 11, 0.0, 1, 1, 1), (9, 0.7, 3, 0.0, 2, 0.0, 1, 1, 1),
    (2, 1.0, 90, 0.0, 85, 0.0, 1, 1, 1), (12, 1.0, 70, 0.1, 64, 0.0, 1, 1, 1), (4, 0.0, 110, 0.0, 90, 0.0, 1, 1, 1),
    # text of an article between its short lines
    (20, 0.0, 6, 0.0, 3, 0.0, 1, 1, 1), (12, 0.0, 4, 0.0, 0, 0.0, 1, 1, 1), (25, 0.0, 3, 0.0, 5, 0.0, 1, 1, 1),
    (15, 0.0, 8, 0.0, 1, 0.0, 1, 1, 1), (28, 0.0, 1, 0.0, 2, 0.0, 1, 1, 1), (11, 0.0, 2, 0.0, 4, 0.0, 1, 1, 1),
    (20, 0.0, 3, 1.0, 3, 0.0, 1, 1, 1), (12, 0.0, 2, 1.0, 0, 0.0, 1, 1, 1), (28, 0.0, 5, 1.0, 4, 0.0, 1, 1, 1),
    # pages that mark only furniture
    (30, 0.0, 60, 0.0, 8, 0.0, 2, 0, 0), (8, 0.0, 30, 0.0, 44, 0.0, 2, 0, 0), (1, 1.0, 1, 1.0, 8, 0.0, 2, 0, 0),
    (60, 0.02, 12, 0.0, 30, 0.0, 2, 0, 0), (15, 0.5, 58, 0.0, 0, 0.0, 2, 0, 0),
)


# Whole pages that mark no article, as the (words, words in links, 1 for main text)
# of their blocks in order.
LABELLED_PAGES = (
    # a menu, short paragraphs, a line of small print
    ((1, 1, 0), (1, 1, 0), (2, 2, 0), (1, 1, 0), (1, 1, 0), (8, 0, 1), (12, 0, 1), (12, 0, 1), (12, 0, 1), (11, 0, 1),
     (12, 0, 1), (13, 0, 1), (10, 0, 1), (12, 0, 1), (12, 0, 1), (7, 0, 0)),
    # paragraphs under headings, further reading at the end
    ((2, 2, 0), (1, 1, 0), (6, 0, 1), (25, 0, 1), (25, 2, 1), (3, 0, 1), (25, 0, 1), (26, 0, 1), (2, 0, 1), (24, 0, 1),
     (25, 0, 1), (6, 6, 0), (7, 7, 0), (5, 5, 0)),
    # text from the first line to the last
    ((5, 0, 1), (15, 0, 1), (18, 0, 1), (11, 0, 1), (19, 0, 1)),
    ((9, 0, 1), (90, 3, 1), (64, 0, 1), (120, 4, 1), (33, 0, 1), (71, 0, 1)),
    ((60, 0, 1), (14, 0, 1), (22, 0, 1), (9, 0, 1), (45, 0, 1), (12, 0, 1)),
    ((1, 1, 0), (2, 2, 0), (7, 0, 1), (10, 0, 1), (10, 0, 1), (11, 0, 1), (10, 0, 1)),
    ((2, 2, 0), (1, 1, 0), (12, 0, 1), (12, 1, 1), (13, 0, 1), (12, 0, 1), (12, 0, 1)),
    ((1, 1, 0), (8, 0, 1), (16, 0, 1), (18, 0, 1), (14, 0, 1), (16, 0, 1)),
    ((1, 1, 0), (6, 0, 1), (18, 0, 1), (20, 0, 1), (18, 2, 1), (18, 0, 1), (6, 0, 0)),
    # cards that are links as a whole, then text
    ((2, 2, 0), (14, 14, 0), (3, 3, 0), (16, 16, 0), (2, 2, 0), (15, 15, 0), (7, 0, 1), (40, 0, 1), (38, 6, 1), (44, 0, 1)),
    # teasers: a linked title, a line of text
    ((1, 1, 0), (5, 5, 0), (18, 0, 0), (5, 5, 0), (20, 0, 0), (4, 4, 0), (17, 0, 0), (6, 6, 0), (21, 0, 0), (2, 2, 0)),
    # text with links in it
    ((1, 1, 0), (7, 0, 1), (40, 8, 1), (35, 10, 1), (50, 5, 1), (28, 7, 1), (3, 3, 0), (4, 4, 0)),
    # labels of a list of fields
    ((1, 0, 0), (2, 0, 0), (1, 0, 0), (3, 0, 0), (2, 0, 0), (1, 1, 0)),
)


def place_of(zone: int, has_article: int) -> int:
    """2 in an article, 1 on a page that marks none, 0 in furniture or beside an article."""
    return 2 if zone == ARTICLE else int(zone == NEITHER and not has_article)


def labelled_rows() -> list[tuple]:
    """``LABELLED`` and the rows of ``LABELLED_PAGES``: FEATURES, then the label."""
    rows = [(*row[:6], place_of(row[6], row[7]), row[8]) for row in LABELLED]
    for page in LABELLED_PAGES:
        blocks = [("", words, linked, NEITHER) for words, linked, _ in page]
        rows += [(*f, y) for f, (_, _, y) in zip(block_features(blocks), page, strict=True)]
    return rows


def fit_tree(rows: Sequence[Sequence[float]], labels: Sequence[int], *, depth: int = 8, min_leaf: int = 1):
    """A CART tree: (feature, threshold, left if <=, right) or a leaf 0 / 1."""
    ones = sum(labels)
    leaf = int(2 * ones >= len(labels))
    if depth == 0 or ones in (0, len(labels)):
        return leaf

    def impurity(part: list[int]) -> float:
        p = sum(part) / len(part)
        return len(part) * p * (1 - p)

    best = None
    for f in range(len(rows[0])):
        values = sorted({r[f] for r in rows})
        for lo, hi in zip(values, values[1:], strict=False):
            cut = (lo + hi) / 2
            left = [y for r, y in zip(rows, labels, strict=True) if r[f] <= cut]
            right = [y for r, y in zip(rows, labels, strict=True) if r[f] > cut]
            if min(len(left), len(right)) >= min_leaf:
                score = impurity(left) + impurity(right)
                if best is None or score < best[0] - 1e-12:
                    best = (score, f, cut)
    if best is None:
        return leaf
    _, f, cut = best
    side = [r[f] <= cut for r in rows]

    def grow(want: bool):
        picked = [i for i, s in enumerate(side) if s is want]
        return fit_tree([rows[i] for i in picked], [labels[i] for i in picked], depth=depth - 1, min_leaf=min_leaf)

    return (f, cut, grow(True), grow(False))


def default_tree():
    rows = labelled_rows()
    return fit_tree([r[:-1] for r in rows], [r[-1] for r in rows])


def predict(tree, row: Sequence[float]) -> int:
    while isinstance(tree, tuple):
        f, cut, left, right = tree
        tree = left if row[f] <= cut else right
    return tree


def _names(token: str, kind: frozenset) -> bool:
    """Whether a class, id or role names something of this kind: as a whole, or
    as a compound of its words and plain ones (has-sidebar names no sidebar)."""
    if token in kind:
        return True
    parts = re.split(r"[^a-z0-9]+", token)
    return not kind.isdisjoint(parts) and all(w in kind or w in PLAIN_WORDS or not w for w in parts)


def _zone_of(tag: str, attrs: str) -> tuple[int, int] | None:
    """(zone, kind of furniture) that an element opens, or None if it keeps its parent's."""
    names: set[str] = set()
    if attrs:
        for m in _NAMED.finditer(attrs):
            names.update((m[1] or m[2] or m[3] or "").lower().split())
    named = lambda kind: any(_names(t, kind) for t in names)
    if tag in STRONG_TAGS or named(COMMENT_WORDS) and tag not in ("body", "html"):
        return FURNITURE, FIXED
    if tag in ARTICLE_TAGS:
        return ARTICLE, WEAK
    if named(STRONG_WORDS) and tag not in ("body", "html"):
        return FURNITURE, LIFTED
    words = {w for t in names for w in re.split(r"[^a-z0-9]+", t)}
    if words & ARTICLE_WORDS and not words & WEAK_WORDS:
        return ARTICLE, WEAK
    if tag in WEAK_TAGS or (words & WEAK_WORDS and not words & CONTENT_WORDS):
        return FURNITURE, WEAK
    return None


def flat_blocks(page: str) -> list[tuple[str, int, int, int]]:
    """(text, words, words in links, zone) of each flat text block, in order."""
    blocks: list[tuple[str, int, int, int]] = []
    text: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, int, int]] = []  # (tag, zone, strongest kind of furniture above or here)
    in_link = 0  # 1 inside a link, 2 inside one whose end tag comes before the next link
    no_more_ends = False

    def zone() -> int:
        return stack[-1][1] if stack else NEITHER

    def flush() -> None:
        joined = " ".join("".join(text).split())
        if joined:
            blocks.append((joined, len(joined.split()), len("".join(linked).split()), zone()))
        text.clear()
        linked.clear()

    def say(chunk: str) -> None:
        if chunk:
            chunk = html_lib.unescape(chunk)
            text.append(chunk)
            if in_link:
                linked.append(chunk)

    at, end = 0, len(page)
    unclosed: set[str] = set()  # raw tags with no end tag from here on: only the tag itself goes
    while at < end:
        m = _TOKEN.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        if m["raw"]:
            raw = m["raw"].lower()
            if not m["rawattrs"].endswith("/") and raw not in unclosed:
                close = _RAW_END[raw].search(page, at)
                if close:
                    at = close.end()
                elif raw in _RAW_TO_END:
                    at = end
                else:
                    unclosed.add(raw)
            continue
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if tag in INLINE:
            if tag == "a":
                in_link = 0
                if not m["end"]:
                    follows = None if no_more_ends else _LINK.search(page, at)
                    no_more_ends = follows is None
                    in_link = 2 if follows and follows[1] else 1
                linked.append(" ")
            elif tag == "br":
                text.append(" ")
            if not m["end"] and tag not in VOID and tag != "a" and m["attrs"] and _zone_of(tag, m["attrs"]):
                flush()
                stack.append((tag, *_child(stack, tag, _zone_of(tag, m["attrs"]))))
            elif m["end"] and stack and stack[-1][0] == tag:
                flush()
                stack.pop()
            continue
        flush()
        if in_link == 1:  # without an end tag a link ends with its block
            in_link = 0
        if tag in VOID:
            continue
        if m["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        elif tag not in ("p", "html") and not m["attrs"].endswith("/"):
            stack.append((tag, *_child(stack, tag, _zone_of(tag, m["attrs"]))))
        elif tag == "p" and (opened := _zone_of(tag, m["attrs"])):
            stack.append((tag, *_child(stack, tag, opened)))
    flush()
    return blocks


def _child(stack: list, tag: str, opened: tuple[int, int] | None) -> tuple[int, int]:
    above, kind = (stack[-1][1], stack[-1][2]) if stack else (NEITHER, WEAK)
    if kind and (kind == FIXED or opened is None or opened[0] != ARTICLE or tag not in ARTICLE_TAGS):
        return FURNITURE, max(kind, opened[1] if opened else kind)
    if opened is None:
        return above, WEAK
    zone, now = opened
    if zone == FURNITURE and above == ARTICLE:
        return (FURNITURE, FIXED) if now else (ARTICLE, WEAK)  # the article's own header is the article's
    return zone, now


def block_features(blocks: Sequence[tuple[str, int, int, int]]) -> list[tuple]:
    has_article = int(any(b[3] == ARTICLE for b in blocks))
    density = [(0, 0.0), *((b[1], b[2] / b[1]) for b in blocks), (0, 0.0)]
    return [
        (*density[i + 1], *density[i], *density[i + 2], place_of(b[3], has_article)) for i, b in enumerate(blocks)
    ]


def extract_text(page: str | None, tree) -> str:
    blocks = flat_blocks(page or "")
    rows = zip(blocks, block_features(blocks), strict=True)
    return "\n".join(b[0] for b, row in rows if b[3] != FURNITURE and predict(tree, row))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    ship_package(pages.sparkSession)
    tree = default_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract_text(h.as_py(), tree) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages"))
