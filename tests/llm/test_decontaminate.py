import random

import numpy as np

from tablepulse.llm import decontaminate as dc
from tablepulse.llm.arrays import codes_of

from .common import SF, prose, rows


def semi_global(pattern, text):
    """Least edit distance of the pattern to any part of the text."""
    last = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        row = [i]
        for j, y in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return min(last)


def brute_force(text, item):
    """The definition: a window of the item within its budget of some part of the text."""
    text, item = dc.normal(text), dc.normal(item)
    if len(item) < dc.SHORTEST:
        return bool(item) and any(
            text[at : at + len(item)] == item
            and not text[max(at - 1, 0) : at].isalnum()
            and not text[at + len(item) : at + len(item) + 1].isalnum()
            for at in range(len(text))
        )
    last = max(len(item) - dc.WINDOW, 0)
    windows = {item[s : s + dc.WINDOW] for s in {*range(0, last + 1, dc.STEP), last}}
    return any(semi_global(w, text) <= int(dc.BUDGET * len(w)) for w in windows)


def damaged(text, edits, seed):
    rng, letters = random.Random(seed), list(text)
    for _ in range(edits):
        at = rng.randrange(len(letters))
        kind = rng.choice("idr")
        if kind == "d":
            del letters[at]
        else:
            letters[at : at + (kind == "r")] = rng.choice("qwxyz")
    return "".join(letters)


def test_q_grams_hash_alike_only_if_equal():
    text = prose(1, 400)
    grams = dc.q_grams(codes_of(text))
    want = [text[i : i + dc.Q] for i in range(len(text) - dc.Q + 1)]
    by = {}
    for gram, value in zip(want, grams.tolist(), strict=True):
        assert by.setdefault(gram, value) == value
    assert len(set(by.values())) == len(by)
    assert len(dc.q_grams(codes_of("short"))) == 0


def test_banded_search_finds_the_least_edits_in_the_band():
    rng = np.random.default_rng(5)
    for _ in range(200):
        text = rng.integers(0, 3, rng.integers(1, 30)).tolist()
        pattern = rng.integers(0, 3, rng.integers(1, 10)).tolist()
        want = semi_global(pattern, text)
        for budget in (0, 2, 4):
            got = dc.banded_search(pattern, text, 0, len(text), budget)
            assert got == (want if want <= budget else None)


def test_search_equals_brute_force_around_the_budget():
    items = [prose(10 + i, 12 + 3 * i) for i in range(6)] + ["tiny", None]
    windows = dc.cut_windows(list(enumerate(items)))
    seen = {True: 0, False: 0}
    for seed in range(60):
        which = seed % 6
        part = damaged(items[which], random.Random(seed).randint(0, 24), seed)
        text = f"{prose(500 + seed, 30)} {part} {prose(700 + seed, 20)}"
        got = {match["item_id"] for match in dc.find_items(text, windows)}
        for at, item in enumerate(items):
            assert (at in got) == brute_force(text, item or ""), (seed, at)
        seen[which in got] += 1
    assert seen[True] > 10 and seen[False] > 10


def test_table_against_brute_force_for_exact_windows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = set(rows(dc.contaminated(docs, benchmark), "doc_id", "item_id"))
    texts = {r["doc_id"]: dc.normal(r["text"]) for r in docs.collect()}
    for item in benchmark.collect():
        whole = dc.normal(item["text"])
        for doc_id, text in texts.items():
            if whole in text:
                assert (doc_id, item["item_id"]) in got
            if (doc_id, item["item_id"]) in got:
                assert brute_force(text, whole)


def test_edges_and_blocks(spark, documents, monkeypatch):
    item, second = prose(1, 40), prose(2, 40)
    benchmark = spark.createDataFrame(
        [(1, item), (2, second), (3, None), (4, ""), (5, "short one"), (6, item)],
        "item_id long, text string",
    )
    table = [
        (1, f"a {item.upper()} b", "en", "s", "m"), (1, f"a {item.upper()} b", "en", "s", "m"),
        (2, None, "en", "s", "m"), (3, "", "en", "s", "m"), (4, second[20:], "en", "s", "m"),
        (5, prose(3, 300000) + " " + second, "en", "s", "m"), (None, item, "en", "s", "m"),
        (7, prose(4, 90), "en", "s", "m"), (8, "short one", "en", "s", "m"),
    ]
    frame = documents([(*row[:4], "m") for row in table], ", Matches string")
    want = sorted(
        [(1, 1), (1, 1), (1, 6), (1, 6), (4, 2), (5, 2), (8, 5), (None, 1), (None, 6)], key=str
    )
    for block in (dc.BLOCK, 200):
        monkeypatch.setattr(dc, "BLOCK", block)
        got = dc.contaminated(frame, benchmark).select("doc_id", "item_id").collect()
        assert sorted(map(tuple, got), key=str) == want
        clean = dc.drop_contaminated(frame, benchmark)
        assert clean.columns == frame.columns
        assert rows(clean, "doc_id", "Matches") == [(i, "m") for i in (2, 3, 7)]
    assert dc.drop_contaminated(frame, benchmark.limit(0)).count() == len(table)
    assert dc.contaminated(frame.limit(0), benchmark).count() == 0


def test_short_items_are_found_as_whole_words():
    items = ["Tell me", "tell  me", "a b", "", None, "42", "words in all, 24 letters"]
    windows = dc.cut_windows(list(enumerate(items)))
    texts = [
        "please TELL\nme now", "foretell me", "tell mean", "tell me", "42", "142 a bc", "(42)",
        "x words in all, 24 letters", "", prose(4, 50), "ab a b",
    ]
    for text in texts:
        got = {match["item_id"] for match in dc.find_items(text, windows)}
        assert got == {at for at, item in enumerate(items) if brute_force(text, item)}
    assert {m["item_id"] for m in dc.find_items("tell me", windows)} == {0, 1}
    assert dc.cut_windows([(1, None), (2, " ")]) is None


def test_items_with_one_stem_in_slices(monkeypatch):
    stem = "which of the following answers is the right one to the question that was asked here "
    items = [stem + prose(900 + i, 12) for i in range(40)]
    windows = dc.cut_windows(list(enumerate(items)))
    assert len(windows.texts) < sum(map(len, windows.items))
    text = " ".join([prose(1, 30), *[stem + prose(50 + i, 3) for i in range(25)], items[7]])
    want = dc.find_items(text, windows)
    assert {match["item_id"] for match in want} == {
        at for at, item in enumerate(items) if brute_force(text, item)
    }
    for pairs in (1, 500, 20_000):
        monkeypatch.setattr(dc, "PAIRS", pairs)
        got = dc.find_items(text, windows)
        assert {m["item_id"]: m["windows"] for m in got} == {m["item_id"]: m["windows"] for m in want}
