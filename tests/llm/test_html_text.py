import time

import numpy as np
import pytest

from tablepulse.llm import html_text
from tablepulse.llm.boosting import fit_trees
from tablepulse.llm.dom import parse

from .common import SF

MENU = "<nav><ul><li><a href=/a>Menu</a></li></ul></nav>"
PAGES = {
    f"<html><body>{MENU}<article><h1>A&amp;B</h1><p>One  two.\nThree.</p><p>Next, one.</p></article>"
    "<footer>End</footer></body></html>": "A&B\nOne two. Three.\nNext, one.",
    "<article><h1>T</h1><p><b>Bold<br>line<p>Unclosed &lt;p&gt;<p>Cut &am": (
        "T\nBold line\nUnclosed <p>\nCut &am"
    ),
    "<main><p>Kept text.</p><div class='ad'>Buy</div><form><p>Name</p></form><script>x<p>y"
    "</script><style>p{}</style><!-- <p>no</p> --></main><div id=comments><p>Nice!</p></div>": (
        "Kept text."
    ),
    "<article><ul><li>One<li>Two</ul><table><tr><td>A<td>B</table></article>": "One\nTwo\nA\nB",
    "<p hidden>": "",
    "": "",
    "just text": "just text",
    "<<>>< p>&": "<<>>< p>&",
}


@pytest.fixture(scope="module")
def trees(spark):
    return html_text.fit_extractor(spark.read.parquet(f"{SF}/pages.parquet"))


@pytest.mark.parametrize("page", PAGES)
def test_pages(page, trees):
    assert html_text.extract([page], trees) == [PAGES[page]]


def test_examples(trees):
    rivers, bread, walk = html_text.extract(list(html_text.EXAMPLES), trees)
    assert rivers.startswith("On rivers\nThe river") and rivers.endswith("One was built again.")
    assert "cookies" not in bread and "Buy" not in bread and "500 g" in bread
    assert walk.startswith("A walk") and walk.endswith("stubble.")


def test_whole_table_and_edges(spark, trees):
    pages = spark.createDataFrame(
        [(1, None, None, "a"), (2, "u", "<article><p>x</p></article>", "b")] * 2
        + [(3, "u", "<article><p>" + "long text. " * 200000 + "</p></article>", "c")],
        "page_id long, url string, html string, Text string",
    )
    out = html_text.main_text(pages, trees)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted((r.page_id, r.n_chars) for r in out.collect())
    assert got == [(1, 0), (1, 0), (2, 1), (2, 1), (3, 2199999)]
    nothing = pages.limit(0)
    assert html_text.main_text(nothing, html_text.fit_extractor(nothing)).count() == 0


def test_no_child_is_kept_without_its_parent(spark, trees):
    for row in spark.read.parquet(f"{SF}/pages.parquet").collect():
        page = html_text.Page(row["html"])
        keep = page.keep(trees.log_odds(page.features))
        assert all(page.nodes[at].parent in keep for at in keep if at)


def test_best_labelling_is_the_best_of_all():
    page = html_text.Page("<div><p>a</p><div><p>b</p><p>c</p></div></div><p>d</p>")
    rng = np.random.default_rng(2)
    for _ in range(30):
        odds = rng.normal(size=len(page.shown))
        gain = dict(zip(page.shown, odds))
        best = -np.inf
        for mask in range(2 ** len(page.shown)):
            kept = {at for k, at in enumerate(page.shown) if mask >> k & 1}
            if all(page.nodes[at].parent in kept | {0} for at in kept):
                best = max(best, sum(gain[at] * (1 if at in kept else -1) for at in page.shown))
        got = page.keep(odds)
        assert np.isclose(sum(gain[at] * (1 if at in got else -1) for at in page.shown), best)


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(3)
    table = rng.random((2000, 4))
    labels = ((table[:, 0] > 0.5) ^ (table[:, 2] > 0.3)).astype(int)
    trees = fit_trees(table, labels)
    assert ((trees.log_odds(table) > 0) == labels).mean() > 0.97


def test_unclosed_quotes_and_very_deep_pages():
    nodes, events = parse('<p>One <a title="x>hello</a> two, three.</p><p>More</p>')
    assert "".join(text for _, text in events) == "One hello two, three.More"
    start = time.perf_counter()
    deep = parse("<div>" * 100_000 + "text" + "<p>a</span>" * 20_000)[0]
    assert len(deep) == 120_001 and time.perf_counter() - start < 10


def test_clashing_columns(spark, trees):
    page = "<html><body><article><h1>T</h1><p>Some words, and a few more of them.</p></article></body></html>"
    frame = spark.createDataFrame([(1, "u", page, "kept", 5)], "page_id long, url string, html string, _html string, N_CHARS int")
    out = html_text.main_text(frame, trees)
    assert out.columns == ["page_id", "url", "_html", "text", "n_chars"]
    assert out.first()["_html"] == "kept"


def test_broken_markup_never_fails():
    rng = np.random.default_rng(4)
    parts = ["<p>", "</p>", "<div class=", "'", '"', "<", ">", "</", "&", "x ", "<!--", "-->", "<li>",
             "<table>", "</table>", "<td>", "<script>", "</script", "<br/>", "<ul>"]
    for _ in range(300):
        nodes, _ = parse("".join(rng.choice(parts, rng.integers(0, 40))))
        assert all(node.parent < at for at, node in enumerate(nodes))
