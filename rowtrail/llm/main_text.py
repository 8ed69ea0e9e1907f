"""Main text of web pages as the maximum-scoring run of their tokens.

A page becomes a sequence of tags and stretches of words. Words score above 0 and tags below, with weights learned
from labelled pages: those that mark their main region by one ``article`` or ``main`` element, a bounded
sample of them. One linear scan finds the run of tokens with the greatest sum; its words, without those of menus,
adverts, forms and the like, are the text: a line for each block.

Within a marked article only what is furniture by its whole name is left out, at no cost to the run; several marked articles are one region, without
what stands between them.

Weights are log odds of lying inside the marked region, drawn towards fixed defaults where the sample says little.

Cases: null or empty html gives an empty text; broken markup is read as far as it goes, an unfinished tag at the
end is dropped; without labelled pages the defaults hold; pages of any length are read whole, one row at a time;
repeated rows give repeated rows; other columns play no part.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtrail.llm.common import small_batches

SAMPLE_PAGES = 500
#: How many tokens of a kind weigh as much as its default.
DEFAULT_STRENGTH = 20.0

# Names of the public markup language and of common page furniture.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe template svg".split())
LEFT_OUT = set("head nav footer aside form menu button select dialog datalist".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul caption xmp".split())
REPEATING = set("li dt dd tr td th option p".split())
MARKED = {"article", "main"}
ALWAYS = set(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar sidebars ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo "
    "promotion cookie cookies consent gdpr comment comments commentlist disqus respond share sharing social related recommended newsletter "
    "subscribe signup login popup modal".split())
UNLESS_CONTENT = set("header masthead topbar footer notice notices banner alert widget toolbar pagination pager search overlay".split())
CONTENT = set("article post entry content main body story text page layout wrapper container has with no without".split())
#: Parts of a page that an element around the text may be named after (layout with-sidebar, post comments-open): beside a class that names content they hide nothing.
LAYOUT = set("sidebar sidebars comment comments share sharing social related".split())
HOLDERS = CONTENT - set("wrapper container has with no without".split())
STATE_BEFORE, STATE_AFTER = set("has with no without".split()), set("open opened closed enabled disabled".split())
COMMENTS = {"comment", "comments", "commentlist", "disqus", "respond"}
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog".split())

#: Elements whose class or role may make them furniture; of others (headings, paragraphs, words) it says nothing.
CONTAINERS = set("article aside blockquote center details dialog div dl fieldset figure footer header hgroup li main menu nav ol section table td tr ul body".split())
#: Words that tell only the form of a part beside a word that names furniture (related-posts, ad-slot).
PARTS = set("wrapper container box block section area slot unit list posts links link buttons button bar inner outer holder widget panel content".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*+)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)""", re.S)
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

#: Defaults by kind of token. Words in links count for less; the element that marks an article is a wall.
WORD, LINK_WORD = 1.0, 0.3
INLINE, TEXT_BLOCK, OTHER_BLOCK, LINK, FURNITURE, WALL = -0.02, -0.1, -0.5, -0.5, -2.0, -30.0
TEXT_BLOCKS = set("p h1 h2 h3 h4 h5 h6 blockquote pre li ul ol dl dt dd figure figcaption br hr table tbody thead tfoot tr caption xmp".split())


#: An element that is left out of a marked article: it costs nothing, as its words are passed over already.
LEFT = "left out"


def default(kind: str) -> float:
    if kind == LEFT:
        return 0.0
    if kind.startswith("word"):
        return LINK_WORD if kind.endswith(" a") else WORD
    name = kind.lstrip("/")
    if name in MARKED:
        return WALL
    if name == "furniture":
        return FURNITURE
    if name == "a":
        return LINK
    if name in TEXT_BLOCKS:
        return TEXT_BLOCK
    return OTHER_BLOCK if name in BLOCKS else INLINE


def stated(words: list[str]) -> bool:
    """Whether a class says of a page that it has or lacks its furniture (no-sidebar, comments-open), rather than being it."""
    places = [k for k, word in enumerate(words) if word in ALWAYS]
    return bool(places) and (words[-1] in STATE_AFTER or not STATE_BEFORE.isdisjoint(words[:places[0]]))


def furniture(attributes: str, in_article: bool = False) -> set[str]:
    """Words in an element's class, id or role that name page furniture.

    An id of several words is the slug of a title, not a kind. Within a marked article a class is furniture only as a whole: ``alert-level`` or
    ``social-history`` names a subject, ``related-posts`` a part of the page.
    """
    found: set[str] = set()
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values)
        if name.lower() == "role":
            found |= ROLES & {value.strip().lower()}
            continue
        parts = [[word.lower() for word in _WORDS.findall(part)] for part in value.split()]
        if name.lower() == "id":
            parts = [words for words in parts if len(words) == 1]
        holds = any(CONTENT.issuperset(words) and not HOLDERS.isdisjoint(words) for words in parts)
        for listed in parts:
            words = set(listed)
            if in_article and not words <= ALWAYS | UNLESS_CONTENT | PARTS:
                continue
            if not stated(listed):
                found |= words & (ALWAYS - LAYOUT if holds else ALWAYS)
            if not words & CONTENT:
                found |= words & UNLESS_CONTENT
    return found


def tokens(page: str) -> Iterator[tuple[str, str, bool]]:
    """Tokens in page order: (kind, text, breaks a block). Words of page furniture are passed over.

    Each element is put on the stack and taken off once, so the time grows with the page and not with its depth.
    """
    stack: list[str] = []
    blocks: list[str] = ["body"]
    depth = Counter()
    hidden_from: int | None = None  # stack height of the furniture we are in
    strict = False  # it stays furniture even if an article opens in it
    marked = False  # it lies in a marked article, whose run it does not end

    def opened(name: str) -> None:
        stack.append(name)
        depth[name] += 1
        if name in BLOCKS:
            blocks.append(name)

    def closed() -> str:
        name = stack.pop()
        depth[name] -= 1
        if name in BLOCKS:
            blocks.pop()
        return name

    at, end = 0, len(page)
    while at < end:
        match = _TOKEN.search(page, at)
        stop = match.start() if match else end
        if stop > at and hidden_from is None:
            yield f"word {blocks[-1]}" + " a" * (depth["a"] > 0), page[at:stop], False
        if not match:
            break
        at = match.end()
        named = _NAME.match(match[0])
        if not named or not (match["name"] or match[0].endswith(">")):
            continue  # comments, declarations, an unfinished tag
        closing, name = bool(named[1]), named[2].lower()
        breaks = name in BLOCKS
        if closing:
            if depth[name]:
                while closed() != name:
                    pass
                if hidden_from is not None and len(stack) < hidden_from:
                    hidden_from = None
                    yield LEFT if marked else "/furniture", "", True
                    continue
            if hidden_from is None:
                yield f"/{name}", "", breaks
            continue
        if name in RAW:
            ending = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
            at = ending.end() if ending else end
            continue
        attributes = match["rest"] or ""
        in_article = depth["article"] > 0 or depth["main"] > 0
        if hidden_from is not None and name in MARKED and not strict and not furniture(attributes):
            hidden_from = None
        if name in VOID:
            if hidden_from is None:
                yield name, "", breaks
            continue
        if name in REPEATING and stack and stack[-1] == name or stack and stack[-1] == "p" and breaks:
            closed()
        opened(name)
        if hidden_from is not None:
            continue
        signs = furniture(attributes, in_article) if attributes and name in CONTAINERS and name != "body" else set()
        if name in LEFT_OUT or signs or name == "header" and not in_article:
            hidden_from, strict, marked = len(stack), name in LEFT_OUT or bool(signs & COMMENTS), in_article
            yield LEFT if marked else "furniture", "", True
        else:
            yield name, "", breaks


def kind_counts(page: str) -> Counter:
    """Of a labelled page, tokens of each kind inside and outside its marked region: {(kind, inside): n}."""
    counts: Counter = Counter()
    inside = 0
    for kind, text, _ in tokens(page):
        name = kind.lstrip("/")
        if name in MARKED:
            inside = max(0, inside + (-1 if kind[0] == "/" else 1))
            continue
        if kind == LEFT:
            continue
        counts[kind, inside > 0] += len(text.split()) if kind.startswith("word") else 1
    return counts


def weights_of(rows: list[tuple[str, int, int]]) -> dict[str, float]:
    """Weights from (kind, inside, outside): log odds drawn to the default, above 0 for words and below for tags."""
    weights = {}
    for kind, inside, outside in rows:
        odds = math.log((inside + 0.5) / (outside + 0.5))
        n = inside + outside
        value = (n * odds + DEFAULT_STRENGTH * default(kind)) / (n + DEFAULT_STRENGTH)
        weights[kind] = min(3.0, max(0.05, value)) if kind.startswith("word") else max(-8.0, min(-0.01, value))
    return weights


def best_run(scores: list[float]) -> tuple[int, int]:
    """First and last-but-one place of the run with the greatest sum, the first such; empty if nothing is above 0."""
    best, run, start, found = 0.0, 0.0, 0, (0, 0)
    for place, value in enumerate(scores):
        if run <= 0:
            run, start = 0.0, place
        run += value
        if run > best:
            best, found = run, (start, place + 1)
    return found


def joined_articles(listed: list[tuple[str, str, bool]]) -> list[tuple[str, str, bool]]:
    """Tokens of a page with several marked regions as of one region: what stands between them is left out, at no cost."""
    edges, inside = [], 0
    for place, (kind, _, _) in enumerate(listed):
        name = kind.lstrip("/")
        if name in MARKED:
            before = inside
            inside = max(0, inside + (-1 if kind[0] == "/" else 1))
            if (before > 0) != (inside > 0):
                edges.append(place)
    if len(edges) <= 2:
        return listed
    out, done = [], 0
    for closing, opening in zip(edges[1:-1:2], edges[2::2], strict=False):
        out += listed[done:closing] + [(LEFT, "", True)]
        done = opening + 1
    return out + listed[done:]


def extract(page: str | None, weights: dict[str, float]) -> str:
    """The main text of a whole page, a line for each block."""
    listed = joined_articles(list(tokens(page or "")))
    scores = []
    for kind, text, _ in listed:
        weight = weights[kind] if kind in weights else default(kind)
        scores.append(weight * len(text.split()) if kind.startswith("word") else weight)
    first, last = best_run(scores)
    blocks: list[str] = []
    parts: list[str] = []

    def close() -> None:
        line = " ".join("".join(parts).split())
        if line:
            blocks.append(line)
        parts.clear()

    for kind, text, breaks in listed[first:last]:
        if kind.startswith("word"):
            parts.append(html.unescape(text))  # a reference ends where a tag begins
        elif breaks:
            close()
        elif kind in ("br", "td", "th", "/td", "/th"):
            parts.append(" ")
    close()
    return "\n".join(blocks)


def learn_weights(pages: DataFrame) -> dict[str, float]:
    """Weights from at most ``SAMPLE_PAGES`` labelled pages, the ones with the least hash of their id."""
    small_batches(pages.sparkSession)
    labelled = pages.filter(F.lower("html").rlike("<(article|main)[\\s>]"))
    chosen = labelled.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE_PAGES)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for page in batch["html"]:
                counts.update(kind_counts(page))
        yield pd.DataFrame([(kind, inside, n) for (kind, inside), n in counts.items()], columns=["kind", "inside", "n"])

    counted = labelled.join(F.broadcast(chosen), "page_id", "left_semi").select("html").mapInPandas(count, "kind string, inside boolean, n long")
    rows = counted.groupBy("kind").agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("inside"), F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("outside")).collect()
    return weights_of(sorted((row["kind"], row["inside"], row["outside"]) for row in rows))


def extract_column(spark: SparkSession, page: Column, weights: dict[str, float]) -> Column:
    """The main text of each page."""
    small_batches(spark)

    @F.pandas_udf("string")
    def extracted(pages: pd.Series) -> pd.Series:
        return pd.Series([extract(value, weights) for value in pages], index=pages.index, dtype=object)

    return extracted(page)
