"""Main text of web pages by boosted trees over the nodes of the page.

Every block element is a node with features: kind of tag, words of its attributes and of
those above it, depth, density of text and of links in its subtree, and how it compares
with its siblings. Gradient-boosted trees give each node the log odds of being main text.
Decoding is hierarchical: a node is kept only if its parent is, and the labels with the
highest total under this rule are found by one pass up and one down the tree, so that no
decision contradicts one above it.

The trees are fitted on a bounded sample, ``SAMPLE`` pages with the smallest hash and a
few pages below that show kinds of boilerplate. Labels are weak ones from the markup:
inside ``article`` or ``main`` and not in an element that by its tag or its attributes is
boilerplate. Each row is also learned with these hints blanked, so that pages without
such markup are judged by density, depth and siblings. Only rows of numbers of the
sample reach the driver. Extraction reads every page once, without a shuffle.

Null, empty and text-free pages give an empty text. Broken markup never fails. A page
without any block of main text gives an empty text. Repeated rows give equal rows; all
other columns are kept, except ``text`` and ``n_chars``, which are replaced. Without
pages the built-in examples alone are learned from, and no row is given.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .arrays import bounded_batches, free_name, without
from .boosting import Trees, fit_trees
from .dom import BLOCKS, Node, parse

SAMPLE = 400

# Elements and attribute words that mark main text or boilerplate.
MAIN_TAGS = frozenset(["article", "main"])
OTHER_TAGS = frozenset(["nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"])
MAIN_WORDS = re.compile(
    r"\b(?:article|content|entry|main|post|story|body|text|articlebody|prose)\b"
)
OTHER_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|alert|banner|breadcrumbs?|byline|comments?|consent|cookies?"
    r"|copyright|disqus|feedback|footer|gdpr|header|hidden|login|masthead|menu|modal|nav|navbar"
    r"|navigation|newsletter|notices?|notification|paywall|popup|promo\w*|recommend\w*|related"
    r"|replies|reply|respond|search|share|sharing|sidebar|signup|skip|social|sponsor\w*"
    r"|subscribe|subscription|tags?|teaser|toc|toolbar|widgets?)(?=$|[\s_-])"
)

HINTS = ("in_main", "in_other", "main_words", "other_words", "other_above")
FEATURES = (
    *HINTS, "depth", "heading", "paragraph", "list", "table", "container", "log_text", "density",
    "links", "link_share", "stops", "share_of_page", "share_of_parent", "place", "siblings",
    "same_tag", "parent_links", "words_a_block",
)
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
LISTS = frozenset(["ul", "ol", "dl", "li", "dt", "dd"])
TABLES = frozenset(["table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"])
PARAGRAPHS = frozenset(["p", "blockquote", "pre", "figcaption"])

# Kinds of boilerplate and of layout that a sample may lack.
EXAMPLES = (
    "<body><header class='site-header'><a href=/>Home</a></header><div id=content><article>"
    "<h1>On rivers</h1><p>The river rose for a week, and nobody had seen it so high. Boats lay in"
    " the fields.</p><aside class=related><ul><li><a href=/1>More</a><li><a href=/2>News</a></ul>"
    "</aside><p>When it fell, the banks had moved, and the old bridge stood beside the water.</p>"
    "<ul><li>Two mills were lost.<li>One was built again.</ul></article></div>"
    "<div class=sidebar><p>Read our other stories.</p></div><section id=comments class=comments>"
    "<div class=comment><p>I saw it too, it was quite a sight to see that year.</p></div><div"
    " class=comment><p>Great story, thank you.</p></div><form><label>Your name</label><p>Leave a"
    " reply below.</p></form></section><footer><p>All rights reserved.</p></footer></body>",
    "<body><nav class=menu><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><div"
    " class=cookie-notice><p>We use cookies to improve your visit. Please accept them.</p></div>"
    "<main><h1>Bread</h1><div class=ad><p>Buy our flour today, only this week.</p></div><p>Mix flour"
    " and water, wait a night, then bake it in a hot oven until it is dark.</p><blockquote>A loaf"
    " takes patience.</blockquote><table><tr><td>Flour<td>500 g</table></main><div"
    " class='newsletter-signup'><form><p>Subscribe to our letter for more.</p></form></div></body>",
    "<body><div class=top><a href=/>Start</a> <a href=/x>Shop</a></div><div class=page><div"
    " class=article><h2>A walk</h2><p>We left at dawn, and by noon the hills lay behind us, blue and"
    " small.</p><p>Nobody spoke much. The path was dry, and larks sang over the stubble.</p><div"
    " class='share social'><a href=/s>Share</a></div></div><div class=widget><p>Popular now</p><a"
    " href=/p>One</a></div></div><div class=footer><p>Contact, imprint, terms of use.</p></div>",
)


def _hinted(nodes: list[Node]) -> list[tuple[bool, bool, bool, bool, bool]]:
    """For each node: in main, in other, own main and other words, other words above."""
    out = [(False,) * 5]
    for node in nodes[1:]:
        main, other, _, other_words, above = out[node.parent]
        out.append(
            (
                main or node.tag in MAIN_TAGS,
                other or node.tag in OTHER_TAGS,
                bool(node.words and MAIN_WORDS.search(node.words)),
                bool(node.words and OTHER_WORDS.search(node.words)),
                above or other_words,
            )
        )
    return out


class Page:
    """A parsed page with the features of its block elements."""

    def __init__(self, html: str | None):
        self.nodes, self.events = parse(html or "")
        nodes, count = self.nodes, len(self.nodes)
        chars, linked, blocks, tags, links, stops = np.zeros((6, count))
        link = [False] * count
        for at, node in enumerate(nodes[1:], 1):
            link[at] = link[node.parent] or node.tag == "a"
            tags[at] += 1
            links[at] += node.tag == "a"
            blocks[at] += node.tag in BLOCKS
        for at, text in self.events:
            size = len(text.strip())
            chars[at] += size
            stops[at] += text.count(". ") + text.count(", ") + text.endswith(".")
            if link[at]:
                linked[at] += size
        parents = [node.parent for node in nodes]
        for at in range(count - 1, 0, -1):
            up = parents[at]
            for column in (chars, linked, blocks, tags, links, stops):
                column[up] += column[at]
        self.hints = _hinted(nodes)
        self.shown = [
            at for at, node in enumerate(nodes) if at and node.tag in BLOCKS and not node.silent
        ]
        children: dict[int, list[int]] = {}
        for at in self.shown:
            children.setdefault(parents[at], []).append(at)
        place = {at: k for row in children.values() for k, at in enumerate(row)}
        alike: dict[tuple[int, str], int] = {}
        for at in self.shown:
            key = (parents[at], nodes[at].tag)
            alike[key] = alike.get(key, 0) + 1
        rows = []
        for at in self.shown:
            node, up = nodes[at], parents[at]
            siblings = len(children[up])
            rows.append(
                (
                    *map(float, self.hints[at]),
                    node.depth,
                    node.tag in HEADINGS,
                    node.tag in PARAGRAPHS,
                    node.tag in LISTS,
                    node.tag in TABLES,
                    blocks[at] > 1,
                    np.log1p(chars[at]),
                    chars[at] / tags[at],
                    links[at],
                    linked[at] / max(chars[at], 1),
                    stops[at] / max(chars[at], 1) * 100,
                    chars[at] / max(chars[0], 1),
                    chars[at] / max(chars[up], 1),
                    place[at] / siblings,
                    siblings,
                    alike[up, node.tag] / siblings,
                    linked[up] / max(chars[up], 1),
                    chars[at] / max(blocks[at], 1),
                )
            )
        self.features = np.array(rows, dtype=np.float64).reshape(-1, len(FEATURES))

    def labels(self) -> np.ndarray:
        """1 and 0 by the markup, -1 where it does not tell."""
        marks = []
        for at in self.shown:
            main, other, _, other_words, above = self.hints[at]
            marks.append(0 if other or other_words or above else 1 if main else -1)
        return np.array(marks)

    def keep(self, odds: np.ndarray) -> set[int]:
        """Nodes kept by the best consistent labelling."""
        gain = dict(zip(self.shown, odds.tolist(), strict=True))
        kept = [0.0] * len(self.nodes)
        dropped = [0.0] * len(self.nodes)
        for at in range(len(self.nodes) - 1, 0, -1):
            up, own = self.nodes[at].parent, gain.get(at, 0.0)
            kept[at] += own / 2
            dropped[at] -= own / 2
            kept[up] += max(kept[at], dropped[at])
            dropped[up] += dropped[at]
        out = {0}
        for at, node in enumerate(self.nodes[1:], 1):
            forced = node.tag in ("html", "body")
            if node.parent in out and (forced or kept[at] >= dropped[at]):
                out.add(at)
        return out

    def text(self, keep: set[int]) -> str:
        """Kept blocks in page order, white space inside a block as one space."""
        blocks, block = [], []
        for at, part in self.events:
            if part:
                if at in keep:
                    block.append(part)
                continue
            blocks.append("".join(block))
            block = []
        blocks.append("".join(block))
        return "\n".join(filter(None, (" ".join(x.split()) for x in blocks)))


def _sample_rows(html: str | None) -> tuple[np.ndarray, np.ndarray]:
    page = Page(html)
    labels = page.labels()
    known = labels >= 0
    return page.features[known], labels[known]


@functools.cache
def _examples() -> tuple[np.ndarray, np.ndarray]:
    rows = []
    for page in EXAMPLES:
        # The last example has no article element: its class says the same.
        marked = page.replace("<div class=article>", "<article class=article>")
        rows.append(_sample_rows(marked))
    return np.concatenate([x for x, _ in rows]), np.concatenate([y for _, y in rows])


def fit_extractor(pages: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees from the pages with the smallest hash and the examples."""
    bounded_batches(pages.sparkSession)

    def measure(batches):
        for batch in batches:
            found = [_sample_rows(html) for html in batch.column(0).to_pylist()]
            rows = np.concatenate([x for x, _ in found]) if found else np.empty((0, len(FEATURES)))
            marks = np.concatenate([y for _, y in found]) if found else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(rows), pa.list_(pa.float64())),
                    pa.array(marks.astype(np.int32), pa.int32()),
                ],
                ["features", "label"],
            )

    chosen = pages.select("html").where("html IS NOT NULL")
    chosen = chosen.orderBy(F.xxhash64("html"), "html").limit(sample)
    rows = chosen.mapInArrow(measure, "features array<double>, label int").collect()
    rows.sort()
    table, labels = _examples()
    table, labels = np.tile(table, (8, 1)), np.tile(labels, 8)
    if rows:
        table = np.concatenate([table, np.array([row["features"] for row in rows])])
        labels = np.concatenate([labels, np.array([row["label"] for row in rows])])
    blank = table.copy()
    blank[:, : len(HINTS)] = 0
    return fit_trees(np.concatenate([table, blank]), np.concatenate([labels, labels]))


def extract(html: list[str | None], trees: Trees) -> list[str]:
    pages = [Page(page) for page in html]
    sizes = np.cumsum([len(page.shown) for page in pages])
    if not len(sizes):
        return []
    odds = trees.log_odds(np.concatenate([page.features for page in pages]))
    parts = np.split(odds, sizes[:-1])
    return [page.text(page.keep(part)) for page, part in zip(pages, parts, strict=True)]


def main_text(pages: DataFrame, trees: Trees) -> DataFrame:
    """All columns of ``pages`` but ``html``, with ``text`` and ``n_chars``."""
    spark = pages.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(trees)
    kept = without(pages.columns, ("html", "text", "n_chars"))
    read = pages.select(*kept, pages["html"].alias(free_name("_html", kept)))

    def read_pages(batches):
        for batch in batches:
            texts: list[str] = []
            html = batch.column(len(kept)).to_pylist()
            for begin in range(0, len(html), 64):
                texts += extract(html[begin : begin + 64], shared.value)
            columns = [*batch.columns[:-1], pa.array(texts, pa.string())]
            columns.append(pa.array([len(text) for text in texts], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, [*kept, "text", "n_chars"])

    answers = [StructField("text", StringType()), StructField("n_chars", LongType())]
    return read.mapInArrow(read_pages, StructType([*read.schema.fields[:-1], *answers]))
