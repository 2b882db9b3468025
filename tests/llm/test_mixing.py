import re

import pytest

from tablepulse.llm import mixing
from tablepulse.llm.arrays import WORD

from .common import prose


def poured(sizes, weights, share, cap):
    """Targets by repeated sharing: the rule as it is told."""
    left, full = share * sum(sizes.values()), {}
    while True:
        free = {s: w for s, w in weights.items() if s not in full}
        level = left / sum(free.values()) if free else 0
        over = {s: cap * sizes[s] for s, w in free.items() if w * level > cap * sizes[s]}
        if not over:
            return full | {s: w * level for s, w in free.items()}
        full |= over
        left -= sum(over.values())


def sample(documents):
    rows = []
    for source, count in (("a", 200), ("b", 90), ("é", 300), ("z", 40), ("~", 10), (None, 60)):
        rows += [(len(rows) + i, prose(i, 5 + i % 40), "en", source) for i in range(count)]
    rows += [(9000, None, "en", "a"), (9001, "", "en", "a"), (9002, "x", "en", "empty")]
    return [*rows, rows[0], rows[0], (None, "no id", "en", "b")]


def test_targets_and_copies(documents):
    table = sample(documents)
    mixed = mixing.mix_sources(documents(table)).collect()
    sizes = {}
    for _, text, _, source in table:
        sizes[source] = sizes.get(source, 0) + len(re.findall(WORD, text or ""))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want = poured(sizes, weights, 1.5, 2.0)
    taken = {}
    for row in mixed:
        assert row["source_size"] == sizes[row["source"]]
        assert row["target"] == pytest.approx(want[row["source"]])
        assert row["taken"] == row["copies"] * row["size"] <= 2 * row["size"]
        taken[row["source"]] = taken.get(row["source"], 0) + row["taken"]
    assert len(mixed) == len(table)
    for source in ("a", "b", "é"):
        assert taken[source] == pytest.approx(want[source], rel=0.15)


def test_reruns_agree_whatever_the_partitioning(documents):
    frame = documents(sample(documents))
    pick = ("doc_id", "source", "copies", "taken")
    once = mixing.mix_sources(frame.repartition(1)).select(*pick).collect()
    again = mixing.mix_sources(frame.repartition(7)).select(*pick).collect()
    assert sorted(once, key=str) == sorted(again, key=str)


def test_copies_are_emitted_and_clashing_columns_replaced(documents):
    table = [(i, "a b c", "en", "s", 7, "k") for i in range(20)]
    frame = documents(table, ", Size long, _source string")
    mixed = mixing.mix_sources(frame)
    assert [c.lower() for c in mixed.columns].count("size") == 1
    copies = mixing.emit_copies(mixed)
    assert copies.count() == sum(row["copies"] for row in mixed.collect())
    assert {row["_source"] for row in copies.collect()} == {"k"}


def test_empty_tables_and_wordless_sources(documents):
    assert mixing.mix_sources(documents([]).limit(0)).count() == 0
    rows = mixing.mix_sources(documents([(1, None, "en", "a"), (2, " ", "en", None)])).collect()
    assert {(r["target"], r["taken"]) for r in rows} == {(0.0, 0)}
