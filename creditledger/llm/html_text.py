"""HTML extraction: flat text blocks, classified by a decision tree, make the main text.

A page is read as a flat sequence of text blocks: runs of text between tags that end a line.
A block is described by its number of words and its link density, the same of the block before
and after it, and by where it stands: inside an element for navigation, advertising and the
like, inside the article, or inside a heading.  A decision tree grown on the small labelled
table below decides which blocks are main text.

A word in a container's id, class or role is a hint: a full one if it is a whole name or the
last word of one (``cookie-banner``), half a one if it is another part of a name or begins one,
when long blocks without links stay; none in a name like ``has-sidebar``.  It is no hint on a
container that holds the page's article, or most of its text.  The hint of a paragraph or list
item lasts to its end; text within an inline element with a full hint is left out, up to its end
or that of the block.  A short line of copyright outside an article is a notice.  Of a page in
which nothing is main text, the blocks without hints that are no links are.

The tree is grown on the driver from the table, some dozens of rows, and has a few nodes.
Pages are worked on one by one in Arrow batches; they are never shuffled.

Defined results: null, empty and broken pages give what text they have, else an empty string;
unclosed tags, comments and scripts end with the page; scripts, styles and the head are never
text.  Repeated rows give equal results.  Other columns are left alone; working columns are
named ``_html...``.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, read

# Fixed values of HTML: elements by their role.
HIDDEN = (
    "script style noscript template head title svg math iframe object canvas select textarea button"
)
#: Of these, the text up to the end of the page is hidden if the end tag is missing.
RAW = "script style title textarea"
VOID = "wbr img"
INLINE = (
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr img"
)
BOILERPLATE = "nav aside footer form menu dialog"
ARTICLE = "article main"
HEADINGS = "h1 h2 h3 h4 h5 h6"
#: Elements that may hold blocks and are closed by their own end tag.
CONTAINERS = (
    "div section article main nav aside header footer form ul ol dl table tr td menu dialog "
    "figure details fieldset body html"
)
#: Words in ids, classes and roles that tell what an element is for.
HINTS = (
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice alert popup modal newsletter subscribe signup paywall "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar aside widget "
    "footer header masthead topbar toolbar comment comments reply replies disqus discussion "
    "share sharing social related recommended recommendations trending popular tags login "
    "search complementary contentinfo"
)
#: Beginnings of such words.
HINT_STARTS = "comment cookie advert sponsor sidebar newsletter breadcrumb promo related disqus"
#: Of these, words that only tell something outside an article.
PAGE_HINTS = "header masthead"


@dataclass
class Block:
    text: str
    words: int
    link_density: float
    boilerplate: float
    article: bool
    heading: bool


@dataclass
class Names:
    """The fixed values as sets."""

    hidden = frozenset(HIDDEN.split())
    raw = frozenset(RAW.split())
    inline = frozenset(INLINE.split())
    void = frozenset(VOID.split())
    boilerplate = frozenset(BOILERPLATE.split())
    article = frozenset(ARTICLE.split())
    headings = frozenset(HEADINGS.split())
    containers = frozenset(CONTAINERS.split())
    hints = frozenset(HINTS.split())
    hint_starts = tuple(HINT_STARTS.split())
    page_hints = frozenset(PAGE_HINTS.split())
    ends = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in HIDDEN.split()}


MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDING = re.compile(
    r"display\s*:\s*none|visibility\s*:\s*hidden|aria-hidden\s*=\s*[\"']?true", re.I
)
HIDDEN_FLAG = re.compile(r"(?:^|\s)hidden(?=\s|$|=|/)", re.I)
QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
NAME_PARTS = re.compile(r"[a-zA-Z]+")
#: How sure it is that an element is not for the article: by a part of a name, a name, its kind.
PART, NAME, KIND = 0.5, 1.0, 2.0
#: Words that begin names of what a container has or goes without.
ABOUT = ("has", "with", "no", "without", "hide", "show")
COPYRIGHT = re.compile(
    r"(?:\u00a9|\(c\)|copyright\b).*(?:\b(?:19|20)\d\d\b|\brights\b.*\breserved\b)", re.I | re.S
)
#: A line of copyright has at most this many words.
COPYRIGHT_WORDS = 30
#: Words that a container must hold at least, and its share of the page's, to be no hint; the
#: share that the article within it must have.
WRAPPER_WORDS, WRAPPER_SHARE, ARTICLE_SHARE = 50, 0.5, 1 / 3


def unwanted(name: str, attributes: str, in_article: bool) -> float:
    """How sure it is that an element is for something else than the article; 0 if nothing says."""
    if name in Names.boilerplate or name == "header" and not in_article:
        return KIND
    if not attributes or name in ("body", "html", "article", "main"):
        return 0.0
    if HIDING.search(attributes) or HIDDEN_FLAG.search(QUOTED.sub("", attributes)):
        return KIND
    level = 0.0
    for found in ATTRIBUTE.finditer(attributes):
        value = found.group(1) or found.group(2) or found.group(3) or ""
        for token in value.lower().split():
            parts = NAME_PARTS.findall(token)
            if len(parts) > 1 and parts[0] in ABOUT:
                continue
            for part in parts:
                if part in Names.hints or part.startswith(Names.hint_starts):
                    if not (in_article and part in Names.page_hints):
                        whole = part == parts[-1] and part in Names.hints
                        level = max(level, NAME if whole else PART)
    return level


def weigh(found: list[Block], under: list[tuple], hints: list[float], articles: list) -> None:
    """Set ``boilerplate`` by the hints that each block is ``under``, but for the page's wrappers.

    ``hints`` has the level of each hint, ``articles`` for each article element the hints it is
    under and its words.
    """
    held = [0] * len(hints)
    total = 0
    for block, own in zip(found, under, strict=True):
        total += block.words if not block.boilerplate else 0
        for hint in own:
            held[hint] += block.words
    least = max(WRAPPER_WORDS, WRAPPER_SHARE * total)
    most = {hint for hint, words in enumerate(held) if words > least}
    # Comments may be longer than the article: what stands beside one is not the page's wrapper.
    outside = [set(own) for own, words in articles if words >= WRAPPER_WORDS and most.issuperset(own)]
    wrappers = {hint for hint in most if all(hint in own for own in outside)}
    above, words = max(articles, key=lambda a: a[1], default=((), 0))
    if words >= max(WRAPPER_WORDS, ARTICLE_SHARE * total):
        wrappers.update(above)
    for block, own in zip(found, under, strict=True):
        left = [hints[hint] for hint in own if hint not in wrappers]
        block.boilerplate = 1.0 if block.boilerplate else max(left, default=0.0)


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page, in its order."""
    found: list[Block] = []
    # Of each open element: name, whether its kind, or that of one around it, is not for the
    # article, the articles and the hints around it, its own included.
    stack: list[tuple[str, bool, tuple, tuple]] = []
    n_open: Counter[str] = Counter()
    under: list[tuple] = []
    hints: list[float] = []
    articles: list[list] = []
    open_parts: list[tuple[str, bool]] = []
    heading, links = "", 0
    hidden_until = ""
    # An inline element that is left out, and how many of its name are open.
    left_out, depth = "", 0

    def around() -> tuple[bool, tuple, tuple]:
        return stack[-1][1:] if stack else (False, (), ())

    def opened(name: str, level: float) -> None:
        bad, own, above = around()
        if name in Names.article:
            articles.append([above, 0])
            own = (*own, len(articles) - 1)
        if 0 < level < KIND:
            hints.append(level)
            above = (*above, len(hints) - 1)
        stack.append((name, bad or level == KIND, own, above))
        n_open[name] += 1

    def closed() -> str:
        name = stack.pop()[0]
        n_open[name] -= 1
        return name

    def flush() -> None:
        if not open_parts:
            return
        raw = "".join(part for part, _ in open_parts)
        text = " ".join(raw.split())
        if text:
            linked = sum(len(part.split()) for part, in_link in open_parts if in_link)
            words = len(text.split())
            bad, own, above = around()
            if not own and words <= COPYRIGHT_WORDS and COPYRIGHT.match(text):
                bad = True
            for article in own:
                articles[article][1] += words
            density = min(1.0, linked / words)
            found.append(Block(text, words, density, bad, bool(own), bool(heading)))
            under.append(above)
        open_parts.clear()

    at = 0
    while at <= len(page):
        if hidden_until:
            # The content of a hidden element is skipped up to its end tag.
            end = Names.ends[hidden_until].search(page, at)
            if end or hidden_until in Names.raw:
                at = end.end() if end else len(page) + 1
            hidden_until = ""
            continue
        tag = MARKUP.search(page, at)
        stop = tag.start() if tag else len(page)
        if stop > at and not left_out:
            open_parts.append((entities.unescape(page[at:stop]), links > 0))
        if not tag:
            break
        at = max(tag.end(), stop + 1)
        if tag.group(2) is None:
            continue
        closing, name, attributes = bool(tag.group(1)), tag.group(2).lower(), tag.group(3) or ""
        if name in Names.hidden:
            if not closing and not attributes.rstrip().endswith("/"):
                hidden_until = name
            continue
        if name in Names.inline:
            if name == "a":
                links = max(0, links - 1) if closing else 1
            if left_out:
                depth += (-1 if closing else 1) * (name == left_out)
                left_out = left_out if depth else ""
            elif not closing and name not in Names.void and unwanted(name, attributes, True) >= NAME:
                left_out, depth = name, 1
            continue
        flush()
        left_out = ""
        if name != "br":
            links = 0
        if name in Names.headings:
            heading = "" if closing else name
        if name in Names.containers:
            if closing:
                if n_open[name]:
                    while closed() != name:
                        pass
            else:
                if stack and stack[-1][0] == "p":
                    closed()
                opened(name, unwanted(name, attributes, bool(around()[1])))
            continue
        # Paragraphs and items may lack their end tags: any block ends a paragraph, and the next
        # item, or the end of the list, an item.
        if name != "br" and stack and stack[-1][0] == "p":
            closed()
        if name == "li" and stack and stack[-1][0] == "li":
            closed()
        if not closing and name in ("p", "li") and unwanted(name, attributes, True):
            opened(name, unwanted(name, attributes, True))
    flush()
    weigh(found, under, hints, articles)
    return found


#: Link density up to which a block is text where the tree finds none.
MOST_LINKS = 0.5
#: What the tree looks at, in this order.
FEATURES = (
    "words link_density words_before density_before words_after density_after "
    "boilerplate article heading"
).split()


def described(found: list[Block]) -> np.ndarray:
    """One row of ``FEATURES`` for each block."""
    rows = np.zeros((len(found), len(FEATURES)))
    for i, b in enumerate(found):
        before = found[i - 1] if i else None
        after = found[i + 1] if i + 1 < len(found) else None
        rows[i] = (
            b.words,
            b.link_density,
            before.words if before else 0,
            before.link_density if before else 0.0,
            after.words if after else 0,
            after.link_density if after else 0.0,
            b.boilerplate,
            b.article,
            b.heading,
        )
    return rows


#: Labelled blocks, in the order of FEATURES, the label last: 1 is main text.
LABELLED = (
    # Paragraphs of an article, long and short, with long and short neighbours.
    (80, 0.00, 60, 0.0, 90, 0.0, 0, 1, 0, 1),
    (45, 0.05, 12, 0.0, 70, 0.0, 0, 1, 0, 1),
    (120, 0.02, 0, 0.0, 0, 0.0, 0, 1, 0, 1),
    (1, 0.00, 30, 0.0, 40, 0.0, 0, 1, 0, 1),
    (2, 0.00, 3, 0.0, 2, 0.0, 0, 1, 0, 1),
    (4, 0.00, 0, 0.0, 4, 1.0, 0, 1, 0, 1),
    (6, 0.50, 50, 0.0, 60, 0.0, 0, 1, 0, 1),
    (3, 1.00, 50, 0.0, 60, 0.0, 0, 1, 0, 1),
    (25, 0.10, 4, 1.0, 30, 0.0, 0, 1, 0, 1),
    (14, 0.00, 2, 1.0, 8, 0.9, 0, 1, 0, 1),
    (9, 0.30, 1, 1.0, 1, 1.0, 0, 1, 0, 1),
    # Headings of an article.
    (8, 0.00, 5, 0.0, 60, 0.0, 0, 1, 1, 1),
    (5, 0.00, 1, 1.0, 20, 0.0, 0, 1, 1, 1),
    (3, 0.00, 70, 0.0, 50, 0.1, 0, 1, 1, 1),
    (12, 1.00, 4, 1.0, 60, 0.0, 0, 1, 1, 1),
    # Asides, adverts, notices, forms and comments within an article.
    (12, 0.00, 60, 0.0, 70, 0.0, 1, 1, 0, 0),
    (40, 0.10, 50, 0.0, 40, 0.0, 1, 1, 0, 0),
    (90, 0.00, 80, 0.0, 60, 0.0, 1, 1, 0, 0),
    (3, 1.00, 90, 0.0, 3, 1.0, 1, 1, 0, 0),
    (6, 0.00, 90, 0.0, 30, 0.0, 1, 1, 1, 0),
    # Menus, headers, footers, sidebars, adverts and comments around an article.
    (1, 1.00, 1, 1.0, 1, 1.0, 1, 0, 0, 0),
    (2, 1.00, 1, 1.0, 12, 0.0, 1, 0, 0, 0),
    (10, 0.00, 1, 1.0, 8, 0.0, 1, 0, 0, 0),
    (60, 0.00, 40, 0.0, 50, 0.0, 1, 0, 0, 0),
    (25, 0.20, 60, 0.0, 0, 0.0, 1, 0, 0, 0),
    (7, 0.00, 80, 0.0, 0, 0.0, 1, 0, 0, 0),
    (4, 0.00, 0, 0.0, 3, 1.0, 1, 0, 1, 0),
    (35, 0.60, 3, 1.0, 3, 1.0, 1, 0, 0, 0),
    # Under half a hint: long text without links stays, short text and links do not.
    (80, 0.00, 60, 0.0, 70, 0.0, 0.5, 1, 0, 1),
    (60, 0.00, 50, 0.0, 5, 1.0, 0.5, 0, 0, 1),
    (50, 0.05, 0, 0.0, 60, 0.0, 0.5, 0, 0, 1),
    (20, 0.00, 60, 0.0, 70, 0.0, 0.5, 1, 0, 0),
    (15, 0.00, 40, 0.0, 50, 0.0, 0.5, 0, 0, 0),
    (20, 0.10, 0, 0.0, 0, 0.0, 0.5, 0, 0, 0),
    (3, 1.00, 60, 0.0, 3, 1.0, 0.5, 1, 0, 0),
    (6, 0.00, 2, 1.0, 30, 0.0, 0.5, 0, 1, 0),
    (60, 0.80, 50, 0.8, 40, 0.9, 0.5, 0, 0, 0),
    # Pages without an article element: running text.
    (70, 0.00, 50, 0.0, 60, 0.0, 0, 0, 0, 1),
    (30, 0.10, 45, 0.0, 25, 0.0, 0, 0, 0, 1),
    (25, 0.00, 3, 1.0, 40, 0.0, 0, 0, 0, 1),
    (90, 0.05, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
    (18, 0.00, 60, 0.0, 2, 1.0, 0, 0, 0, 1),
    (5, 0.00, 40, 0.0, 50, 0.0, 0, 0, 0, 1),
    (2, 0.00, 30, 0.1, 25, 0.0, 0, 0, 0, 1),
    (2, 0.00, 25, 0.0, 1, 1.0, 0, 0, 0, 1),
    (1, 0.00, 14, 0.0, 1, 0.0, 0, 0, 0, 1),
    (5, 0.00, 40, 0.0, 0, 0.0, 0, 0, 0, 1),
    (8, 0.20, 35, 0.0, 60, 0.0, 0, 0, 0, 1),
    (6, 0.00, 2, 1.0, 50, 0.0, 0, 0, 1, 1),
    (4, 0.00, 40, 0.0, 45, 0.0, 0, 0, 1, 1),
    (9, 0.00, 0, 0.0, 40, 0.0, 0, 0, 1, 1),
    # Pages without an article element: link lists and scraps.
    (2, 1.00, 2, 1.0, 2, 1.0, 0, 0, 0, 0),
    (3, 1.00, 0, 0.0, 2, 1.0, 0, 0, 0, 0),
    (4, 1.00, 60, 0.0, 3, 1.0, 0, 0, 0, 0),
    (20, 0.80, 10, 0.9, 15, 0.9, 0, 0, 0, 0),
    (40, 0.70, 30, 0.8, 2, 1.0, 0, 0, 0, 0),
    (5, 0.60, 2, 1.0, 40, 0.0, 0, 0, 0, 0),
    (3, 0.00, 2, 1.0, 2, 1.0, 0, 0, 0, 0),
    (6, 0.00, 3, 1.0, 0, 0.0, 0, 0, 0, 0),
    (4, 0.00, 4, 0.5, 3, 0.0, 0, 0, 0, 0),
    (3, 0.00, 2, 0.0, 2, 0.0, 0, 0, 0, 0),
    (2, 0.00, 0, 0.0, 1, 1.0, 0, 0, 1, 0),
    (8, 1.00, 50, 0.0, 70, 0.0, 0, 0, 0, 0),
)


def grow(rows: np.ndarray, labels: np.ndarray):
    """A decision tree by least Gini impurity, grown until its leaves are pure.

    A node is (feature, threshold, at most, above); a leaf is its label.
    """
    if labels.min() == labels.max():
        return int(labels[0])
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for threshold in (values[:-1] + values[1:]) / 2:
            left = rows[:, feature] <= threshold
            impurity = 0.0
            for side in (labels[left], labels[~left]):
                share = side.mean()
                impurity += len(side) * share * (1 - share)
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, feature, float(threshold), left)
    if best is None:
        return int(labels.mean() >= 0.5)
    _, feature, threshold, left = best
    return feature, threshold, grow(rows[left], labels[left]), grow(rows[~left], labels[~left])


def trained():
    table = np.array(LABELLED, float)
    return grow(table[:, :-1], table[:, -1].astype(int))


def is_main(tree, row: np.ndarray) -> bool:
    while not isinstance(tree, int):
        feature, threshold, low, high = tree
        tree = low if row[feature] <= threshold else high
    return bool(tree)


def main_text(page: str | None, tree) -> str:
    """The main text of a page: its main blocks joined by one space."""
    found = blocks_of(page or "")
    rows = described(found)
    main = [b.text for b, row in zip(found, rows, strict=True) if is_main(tree, row)]
    if not main:
        main = [b.text for b in found if not b.boilerplate and b.link_density <= MOST_LINKS]
    return " ".join(main)


def extracted(page: Column) -> Column:
    tree = trained()

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(p, tree) for p in batch], dtype=object)

    return texts(page)


def extract(pages: DataFrame, page: str = "html") -> DataFrame:
    """``pages`` with ``_html_text``, the main text of each page."""
    arrow_rows(pages.sparkSession)
    return pages.withColumn("_html_text", extracted(F.col(page)))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract(read(spark, sf_dir, "pages"))
    text = F.col("_html_text")
    return pages.select(
        "page_id", "url", text.alias("text"), F.length(text).cast("bigint").alias("n_chars")
    )
