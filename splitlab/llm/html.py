"""Main text of web pages: flat text blocks, their neighbours, and a decision tree.

A page becomes a flat list of text blocks, cut at block-level tags. Each block has its word
count, link density and what encloses it; with the counts and densities of the blocks before
and after it, a decision tree trained on the small labelled table below keeps or drops it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitlab.llm.common import pieces, small_batches

# Elements inside a line of text; every other tag ends a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Content that is never text of a page.
SILENT = frozenset("script style template noscript iframe svg math object canvas audio video".split())
# Elements that hold what surrounds an article.
AROUND = frozenset("nav header footer aside form menu button select option textarea dialog fieldset head title".split())
# Words of class, id or role that say the same.
AROUND_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|header|masthead|footer|sidebar|side|aside|widget|cookie\w*|consent|gdpr|notice"
    r"|popup|modal|overlay|newsletter|subscribe|signup|login|search|share|social|related|recommend\w*|breadcrumb\w*|pagination|pager|comment\w*|repl(?:y|ies)|disqus"
    r"|contentinfo|complementary|navigation|legal|copyright|toolbar|tags?|alert)(?=$|[\s_-])",
    re.I,
)
ARTICLE = frozenset(("article", "main"))
ARTICLE_NAMES = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story|content|main|body)(?=$|[\s_-])", re.I)

MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*(?:>|\Z))",
    re.S,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=>/]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)


@dataclass
class Block:
    text: str
    words: int
    linked: float
    around: int  # what encloses it: 1 surroundings, 0 nothing told
    article: int


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order, white space collapsed, character references decoded."""
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = []
    parts: list[str] = []
    links: list[str] = []
    anchor = 0
    around = article = 0

    def flush() -> None:
        text = " ".join(unescape("".join(parts)).split()) if parts else ""
        if text:
            n = len(text.split(" "))
            inside = len(unescape(" ".join(links)).split())
            out.append(Block(text, n, min(inside / n, 1.0), min(around, 1), min(article, 1)))
        parts.clear()
        links.clear()

    at = 0
    while at < len(page):
        found = MARKUP.search(page, at)
        text = page[at : found.start() if found else len(page)]
        if text:
            parts.append(text)
            if anchor:
                links.append(text)
        if not found:
            break
        at = found.end()
        if not (name := found["name"]):
            continue
        name = name.lower()
        if name not in INLINE:
            flush()
        elif name == "br":
            parts.append(" ")
            continue
        if found["close"]:
            if name == "a":
                anchor = 0
            elif any(s[0] == name for s in stack) and name not in INLINE:
                while True:
                    top, x, y = stack.pop()
                    around, article = around - x, article - y
                    if top == name:
                        break
            continue
        if name in SILENT or name == "title":
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            if not found["rest"].rstrip(">").endswith("/"):
                at = end.end() if end else len(page)
            continue
        if name == "a":
            anchor = 1
        if name in VOID or name in INLINE or found["rest"].rstrip(">").endswith("/"):
            continue
        told = " ".join(x or y or z for x, y, z in NAMES.findall(found["rest"]))
        is_article = int(name in ARTICLE or bool(ARTICLE_NAMES.search(told)))
        is_around = int((name in AROUND and not (name == "header" and article)) or bool(AROUND_NAMES.search(told)) or bool(HIDDEN.search(found["rest"])))
        if name in ("body", "html"):
            is_article = is_around = 0
        if name == "p" and stack and stack[-1][0] == "p":  # a paragraph ends the one before it
            _, x, y = stack.pop()
            around, article = around - x, article - y
        stack.append((name, is_around, is_article))
        around, article = around + is_around, article + is_article
    flush()
    return out


FEATURES = ("words", "linked", "words before", "linked before", "words after", "linked after", "around", "article", "page has article")
# The labelled table: features of blocks, and whether a reader called them main text.
LABELLED = np.array(
    [
        # w, linked, before, l.b., after, l.a., around, article, has article, main text
        (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 1, 0), (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 1, 0), (2, 1.0, 1, 1.0, 7, 0.0, 1, 0, 1, 0),
        (7, 0.0, 1, 1.0, 9, 0.0, 1, 0, 1, 0), (11, 0.0, 1, 1.0, 10, 0.0, 1, 0, 1, 0), (45, 0.0, 1, 1.0, 60, 0.0, 1, 0, 1, 0),
        (10, 0.0, 8, 0.0, 60, 0.0, 0, 1, 1, 1), (2, 0.0, 8, 0.0, 90, 0.0, 0, 1, 1, 1), (60, 0.0, 10, 0.0, 5, 0.0, 0, 1, 1, 1),
        (1, 0.0, 60, 0.0, 70, 0.0, 0, 1, 1, 1), (3, 0.0, 90, 0.0, 9, 0.0, 0, 1, 1, 1), (250, 0.02, 40, 0.0, 80, 0.05, 0, 1, 1, 1),
        (35, 0.4, 70, 0.0, 60, 0.1, 0, 1, 1, 1), (12, 0.3, 50, 0.0, 40, 0.0, 0, 1, 1, 1), (9, 0.0, 40, 0.0, 0, 0.0, 1, 0, 1, 0),
        (12, 0.1, 3, 0.0, 0, 0.0, 1, 0, 1, 0), (80, 0.0, 60, 0.0, 12, 0.0, 1, 1, 1, 0), (6, 0.0, 80, 0.0, 40, 0.0, 1, 1, 1, 0),
        (4, 1.0, 60, 0.0, 3, 1.0, 1, 1, 1, 0), (30, 0.0, 9, 0.0, 25, 0.0, 1, 1, 1, 0), (5, 1.0, 4, 1.0, 6, 1.0, 0, 0, 1, 0),
        (15, 0.0, 5, 1.0, 9, 0.0, 0, 0, 1, 0), (40, 0.0, 3, 1.0, 10, 0.0, 0, 0, 1, 0), (8, 0.0, 1, 1.0, 60, 0.0, 0, 0, 1, 0),
        (3, 0.0, 1, 1.0, 8, 0.0, 0, 0, 1, 0), (90, 0.0, 12, 0.0, 70, 0.0, 0, 0, 0, 1), (40, 0.05, 80, 0.0, 60, 0.0, 0, 0, 0, 1),
        (25, 0.0, 30, 0.0, 28, 0.1, 0, 0, 0, 1), (11, 0.0, 60, 0.0, 45, 0.0, 0, 0, 0, 1), (6, 0.0, 3, 1.0, 50, 0.0, 0, 0, 0, 1),
        (14, 0.0, 0, 0.0, 13, 0.0, 0, 0, 0, 1), (16, 0.0, 14, 0.0, 0, 0.0, 0, 0, 0, 1), (3, 1.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0),
        (2, 1.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0), (12, 0.9, 3, 1.0, 40, 0.0, 0, 0, 0, 0), (30, 0.8, 9, 1.0, 25, 0.9, 0, 0, 0, 0),
        (4, 0.0, 3, 1.0, 2, 1.0, 0, 0, 0, 0), (3, 0.0, 4, 1.0, 0, 0.0, 0, 0, 0, 0), (20, 0.6, 15, 0.7, 30, 0.8, 0, 0, 0, 0),
        (4, 1.0, 60, 0.0, 50, 0.0, 0, 1, 1, 1), (6, 1.0, 10, 0.0, 70, 0.0, 0, 1, 1, 1), (50, 0.0, 1, 1.0, 4, 1.0, 1, 0, 0, 0),
        (20, 0.0, 2, 1.0, 30, 0.0, 1, 0, 0, 0), (4, 1.0, 5, 1.0, 4, 1.0, 0, 1, 1, 0), (3, 1.0, 4, 1.0, 5, 1.0, 0, 1, 1, 0),
        (10, 0.0, 1, 1.0, 60, 0.0, 0, 1, 1, 1), (60, 0.0, 1, 1.0, 8, 0.0, 0, 1, 1, 1), (9, 0.0, 3, 1.0, 70, 0.0, 0, 1, 1, 1),
        (70, 0.0, 2, 1.0, 50, 0.0, 0, 0, 0, 1), (8, 0.0, 1, 1.0, 55, 0.0, 1, 1, 1, 0), (4, 0.0, 4, 1.0, 3, 0.0, 0, 1, 1, 1),
        (40, 0.0, 4, 1.0, 30, 0.0, 0, 1, 1, 1), (12, 0.0, 3, 1.0, 9, 0.0, 1, 0, 1, 0), (7, 0.0, 20, 0.0, 3, 0.0, 1, 0, 0, 0),
        (12, 0.0, 5, 0.0, 0, 0.0, 0, 1, 1, 1), (3, 0.0, 0, 0.0, 0, 0.0, 0, 1, 1, 1), (5, 0.0, 0, 0.0, 4, 0.0, 0, 0, 0, 1),
    ]
)


def grow(rows: np.ndarray, depth: int = 6) -> tuple | float:
    """A decision tree by Gini impurity: (feature, threshold, at most, above) or the share of main text."""
    y = rows[:, -1]
    if depth == 0 or len(rows) < 2 or y.min() == y.max():
        return float(y.mean())
    best = None
    for f in range(rows.shape[1] - 1):
        values = np.unique(rows[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            low = rows[:, f] <= t
            cost = sum(part.sum() * y[part].mean() * (1 - y[part].mean()) for part in (low, ~low))
            if best is None or cost < best[0] - 1e-12:
                best = cost, f, float(t), low
    if best is None:
        return float(y.mean())
    _, f, t, low = best
    return f, t, grow(rows[low], depth - 1), grow(rows[~low], depth - 1)


def vote(tree: tuple | float, values: tuple) -> float:
    while not isinstance(tree, float):
        f, t, low, high = tree
        tree = low if values[f] <= t else high
    return tree


def main_text(page: str, tree: tuple | float) -> str:
    """Blocks the tree keeps, joined by newlines."""
    found = blocks(page)
    has = int(any(b.article and not b.around for b in found))
    none = Block("", 0, 0.0, 0, 0)
    kept = []
    for before, b, after in zip([none, *found[:-1]], found, [*found[1:], none]):
        row = (b.words, b.linked, before.words, before.linked, after.words, after.linked, b.around, b.article, has)
        if vote(tree, row) >= 0.5:
            kept.append(b.text)
    return "\n".join(kept)


def extract(pages: DataFrame, html: str = "html", labelled: np.ndarray = LABELLED) -> DataFrame:
    """All columns of ``pages`` but the html, with ``text`` (empty if none) and ``n_chars``.

    NULL or empty html gives an empty text. Broken markup is read as far as it goes. Columns
    already named ``text`` or ``n_chars`` are replaced, others pass through; repeated rows stay.
    An empty table gives an empty result.
    """
    small_batches(pages.sparkSession)
    tree = grow(labelled)
    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    source = pages.select(*(f"`{c}`" for c in kept), F.coalesce(f"`{html}`", F.lit("")).alias("__html"))
    fields = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "__html"):
            texts = [main_text(p, tree) for p in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], [*kept, "text", "n_chars"]
            )

    return source.mapInArrow(run, f"{fields}text string, n_chars bigint")
