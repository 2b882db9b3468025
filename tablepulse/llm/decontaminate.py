"""Benchmark decontamination by q-gram lemma filtering.

Texts are compared in lower case with white space runs as one space. An item is cut
into windows of ``WINDOW`` characters, ``STEP`` apart and one at its end (a shorter
item is one window). A document is contaminated by an item if some part of it is within
the edit budget of a window: 7.5 percent of its characters. Two strings within e edits
share at least ``length - Q + 1 - Q * e`` q-grams on neighbouring diagonals, so

1. q-grams of a document that occur in the benchmark are found by table lookup, and
   only stretches with enough of them for any window are looked at further;
2. their pairs with window q-grams are counted by window and diagonal band; bands
   overlap, so that every match lies within one;
3. what reaches the bound is verified by banded alignment with the window.

Documents are read once, without a shuffle. The windows are broadcast in blocks of
items of at most about ``BLOCK`` characters, one pass over the documents a block.

Null and empty documents and items match nothing. Items with fewer than ``SHORTEST``
characters have too few q-grams: they are found exactly, as whole words, by one automaton
of all of them. Items with equal texts match alike, each under its id; a window that
several items share is sought once. Repeated rows get equal results,
all columns are kept (one named like the result is replaced), empty tables give no match. Very long
texts are read in overlapping pieces, and pairs of equal q-grams are made for at most
``PAIRS`` at a time, or two window lengths of text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .arrays import CHARS, bounded_batches, codes_of, free_name, without

Q = 9
WINDOW = 80
STEP = 40
BUDGET = 0.075
SHORTEST = 25
BLOCK = 4 << 20
PAIRS = 1 << 20
MEMO = 1 << 14
TABLE_BITS = 22

_FACTOR = np.uint32(0x9E3779B1)


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def q_grams(codes: np.ndarray) -> np.ndarray:
    """A 32-bit hash of each run of Q code points."""
    if len(codes) < Q:
        return np.empty(0, np.uint32)
    size, values = 1, codes * _FACTOR
    values ^= values >> np.uint32(15)
    total, done = None, 0
    rest = Q
    while rest:
        if rest & 1:
            part = values[done:]
            if total is None:
                total = part
            else:
                end = min(len(total), len(part))
                total = total[:end] * np.uint32(0x85EBCA77) + part[:end]
            done += size
        rest >>= 1
        if rest:
            values = values[:-size] * np.uint32(0xC2B2AE3D) + values[size:]
            values ^= values >> np.uint32(13)
            size *= 2
    return total[: len(codes) - Q + 1]


def _slots(grams: np.ndarray) -> np.ndarray:
    return (grams * _FACTOR) >> np.uint32(32 - TABLE_BITS)


@dataclass(frozen=True)
class Windows:
    """Different windows of a block of items, where their q-grams occur, and short items."""

    items: list[list]
    texts: list[np.ndarray]
    budgets: np.ndarray
    bounds: np.ndarray
    table: np.ndarray
    grams: np.ndarray
    begin: np.ndarray
    owner: np.ndarray
    offset: np.ndarray
    short: ahocorasick.Automaton | None

    @property
    def reach(self) -> int:
        return max(map(len, self.texts)) + int(self.budgets.max())


def _automaton(items: dict[str, list]) -> ahocorasick.Automaton | None:
    if not items:
        return None
    found = ahocorasick.Automaton()
    for text, names in items.items():
        found.add_word(text, (len(text), names))
    found.make_automaton()
    return found


def cut_windows(items: list[tuple[object, str | None]]) -> Windows | None:
    """The windows of the items; None if every item is empty."""
    short: dict[str, list] = {}
    cut: dict[str, list] = {}
    for name, text in items:
        text = normal(text)
        if len(text) < SHORTEST:
            if text:
                short.setdefault(text, []).append(name)
            continue
        last = max(len(text) - WINDOW, 0)
        for start in sorted({*range(0, last + 1, STEP), last}):
            cut.setdefault(text[start : start + WINDOW], []).append(name)
    if not cut and not short:
        return None
    texts = [codes_of(text) for text in cut]
    budgets = np.array([int(BUDGET * len(text)) for text in texts], np.int64)
    bounds = np.array([len(text) - Q + 1 for text in texts], np.int64) - Q * budgets
    grams = [q_grams(text) for text in texts]
    owner = np.repeat(np.arange(len(texts)), np.array([len(x) for x in grams], np.int64))
    offset = np.concatenate([np.arange(len(x)) for x in grams] or [np.empty(0, np.int64)])
    every = np.concatenate(grams or [np.empty(0, np.uint32)])
    order = np.argsort(every, kind="stable")
    known, begin = np.unique(every[order], return_index=True)
    table = np.zeros(1 << TABLE_BITS, bool)
    table[_slots(known)] = True
    begin = np.append(begin, len(every))
    return Windows(
        list(cut.values()), texts, budgets, bounds, table, known, begin,
        owner[order], offset[order], _automaton(short),
    )


def banded_search(pattern, text, low: int, high: int, budget: int) -> int | None:
    """Least edits, within the budget, that turn ``pattern`` into some part of ``text``
    which begins at one of the places ``low`` to ``high``.

    For each number of edits the furthest place in the pattern is kept for each
    diagonal; only diagonals within the budget of the band are looked at.
    """
    n, m = len(pattern), len(text)
    reached = {d: 0 for d in range(max(low, 0), min(high, m) + 1)}
    for edits in range(budget + 1):
        following: dict[int, int] = {}
        for diagonal, place in reached.items():
            limit = min(n, m - diagonal)
            while place < limit and pattern[place] == text[place + diagonal]:
                place += 1
            if place == n:
                return edits
            for other, step in ((diagonal, 1), (diagonal - 1, 1), (diagonal + 1, 0)):
                to = place + step
                if to <= min(n, m - other) and to + other >= 0 and to > following.get(other, -1):
                    following[other] = to
        reached = following
    return None


def _dense(hits: np.ndarray, size: int, bound: int, reach: int) -> np.ndarray:
    """Those of the ascending places that lie in a stretch with enough of them."""
    upto = np.searchsorted(hits, hits + reach)
    good = np.flatnonzero(upto - np.arange(len(hits)) >= bound)
    if not len(good):
        return hits[:0]
    edge = np.zeros(len(hits) + 1, np.int64)
    np.add.at(edge, good, 1)
    np.add.at(edge, upto[good], -1)
    return hits[np.cumsum(edge[:-1]) > 0]


def _search(codes: np.ndarray, windows: Windows) -> dict[int, tuple[int, int]]:
    """For each window found, one place in the text and the edits there."""
    grams = q_grams(codes)
    hits = np.flatnonzero(windows.table[_slots(grams)])
    bound = max(int(windows.bounds.min()), 1)
    hits = _dense(hits, len(grams), bound, windows.reach)
    if not len(hits):
        return {}
    at = np.searchsorted(windows.grams, grams[hits])
    at[at == len(windows.grams)] = 0
    real = windows.grams[at] == grams[hits]
    hits, at = hits[real], at[real]
    found: dict[int, tuple[int, int]] = {}
    failed: set[tuple] = set()
    upto = np.append(0, np.cumsum(windows.begin[at + 1] - windows.begin[at]))
    start = 0
    while start < len(hits):
        # As many as PAIRS allows, but never less than holds any match that begins here.
        enough = np.searchsorted(hits, hits[start] + 2 * windows.reach)
        end = max(int(np.searchsorted(upto, upto[start] + PAIRS)) - 1, int(enough))
        _count(codes, hits[start:end], at[start:end], windows, found, failed)
        if end >= len(hits):
            break
        start = int(np.searchsorted(hits, hits[end] - windows.reach))
    return found


def _count(codes, hits, at, windows: Windows, found: dict, failed: set) -> None:
    """Add the windows with enough q-grams among the hits in one band, once verified."""
    count = windows.begin[at + 1] - windows.begin[at]
    first = np.cumsum(count) - count
    posting = np.arange(count.sum()) - np.repeat(first - windows.begin[at], count)
    owner, offset = windows.owner[posting], windows.offset[posting]
    diagonal = np.repeat(hits, count) - offset
    if found:
        new = ~np.isin(owner, list(found))
        owner, offset, diagonal = owner[new], offset[new], diagonal[new]
    width = windows.budgets[owner] + 1
    # Band b holds the diagonals from b * width on, twice the width of them; matches
    # spread over at most one width.
    shift = windows.reach
    band = (diagonal + shift) // width
    bands = np.concatenate([band, band - 1])
    owners, offsets = np.tile(owner, 2), np.tile(offset, 2)
    order = np.lexsort((offsets, bands, owners))
    owners, bands, offsets = owners[order], bands[order], offsets[order]
    fresh = np.ones(len(owners), bool)
    fresh[1:] = (owners[1:] != owners[:-1]) | (bands[1:] != bands[:-1])
    different = fresh.copy()
    different[1:] |= offsets[1:] != offsets[:-1]
    start = np.flatnonzero(fresh)
    shared = np.add.reduceat(different, start) if len(start) else start
    for group in np.flatnonzero(shared >= np.maximum(windows.bounds[owners[start]], 1)):
        window = int(owners[start[group]])
        if window in found:
            continue
        budget = int(windows.budgets[window])
        low = int(bands[start[group]]) * (budget + 1) - shift - budget
        high = low + 2 * (budget + 1) + 2 * budget
        begin = max(low - budget, 0)
        end = max(high, 0) + len(windows.texts[window]) + budget
        part = codes[begin:end]
        # Repeated passages bring the same stretch again and again.
        seen = (window, low - begin, part.tobytes())
        if seen in failed:
            continue
        pattern = windows.texts[window].tolist()
        edits = banded_search(pattern, part.tolist(), low - begin, high - begin, budget)
        if edits is not None:
            found[window] = (max(low, 0), edits)
        else:
            if len(failed) >= MEMO:
                failed.clear()
            failed.add(seen)


def _short_items(text: str, automaton: ahocorasick.Automaton):
    """Each short item that stands in the text as whole words, and where."""
    for last, (size, names) in automaton.iter(text):
        first = last - size + 1
        before, after = text[first - 1 : first] if first else "", text[last + 1 : last + 2]
        if not before.isalnum() and not after.isalnum():
            for name in names:
                yield name, first


def find_items(text: str | None, windows: Windows | None) -> list[dict]:
    """The items that a text contains: windows found, one place about where, least edits."""
    if windows is None or not text:
        return []
    text = normal(text)
    by_item: dict = {}
    if windows.texts:
        codes = codes_of(text)
        found: dict[int, tuple[int, int]] = {}
        for base in range(0, max(len(codes), 1), CHARS):
            piece = codes[base : base + CHARS + 2 * windows.reach]
            for window, (place, edits) in _search(piece, windows).items():
                found.setdefault(window, (base + place, edits))
        for window, (place, edits) in sorted(found.items()):
            for item in windows.items[window]:
                by_item.setdefault(item, []).append((place, edits))
    if windows.short:
        for item, place in _short_items(text, windows.short):
            by_item.setdefault(item, [(place, 0)])
    return [
        {
            "item_id": item,
            "windows": len(places),
            "place": min(place for place, _ in places),
            "edits": min(edits for _, edits in places),
        }
        for item, places in by_item.items()
    ]


def _blocks(benchmark: DataFrame):
    """The items in blocks of bounded size."""
    total = benchmark.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).head()[0]
    number = max(1, math.ceil(total / BLOCK))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(number))
    for at in range(number):
        yield benchmark.where(block == at).select("item_id", "text").collect()


def match_benchmark(
    docs: DataFrame, benchmark: DataFrame, into: str = "matches"
) -> DataFrame:
    """All columns of ``docs``, and ``into``: item, windows found, place and least edits."""
    spark = docs.sparkSession
    bounded_batches(spark)
    item = benchmark.schema["item_id"].dataType
    kind = f"array<struct<item_id: {item.simpleString()}, windows: int, place: int, edits: int>>"
    arrow = pa.list_(
        pa.struct(
            [("item_id", to_arrow_type(item))]
            + [(name, pa.int32()) for name in ("windows", "place", "edits")]
        )
    )
    kept = without(docs.columns, [into])
    out = docs.select(*kept, F.array().cast(kind).alias(into))
    at = kept.index("text")
    for block in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(cut_windows([tuple(row) for row in block]))

        def search(batches, shared=shared):
            for batch in batches:
                found = [find_items(text, shared.value) for text in batch.column(at).to_pylist()]
                before = batch.column(len(kept)).to_pylist()
                both = [old + new for old, new in zip(before, found, strict=True)]
                columns = [*batch.columns[:-1], pa.array(both, arrow)]
                yield pa.RecordBatch.from_arrays(columns, [*kept, into])

        out = out.mapInArrow(search, out.schema)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item found in it."""
    matched = match_benchmark(docs.select("doc_id", "text"), benchmark)
    return matched.select("doc_id", F.explode("matches").alias("match")).select("doc_id", "match.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    found = free_name("matches", docs.columns)
    matched = match_benchmark(docs, benchmark, found)
    return matched.where(F.size(found) == 0).select(*docs.columns)
