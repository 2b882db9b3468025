"""Substring dedup by super-k-mer partitioning: exact repeats of long word windows.

A window is ``size`` consecutive words. Its minimiser is the smallest hash among its
runs of ``SEED_WORDS`` words (the first of equals), and neighbouring windows with the
minimiser at the same place form a super-k-mer. Equal windows have equal minimisers,
and two equal windows never lie in one super-k-mer. So:

1. Each document yields its super-k-mers as places and numbers of windows, one row a
   minimiser, without text. Minimisers are counted with map-side sums; one that occurs
   once cannot hold a repeat, and its super-k-mer is dropped here.
2. The words of what is left travel as one packed string to the bucket of their
   minimiser; equal strings of a document travel once, with their places. A task reads
   its buckets in sorted order, one at a time, and sorts the windows of a bucket: equal
   neighbours are repeats, compared as text, not by hash. A bucket of over
   ``BUCKET_ROWS`` documents (some 100 MB of windows) is not gathered: its windows
   become rows of their own, counted with map-side sums and joined back, with equal
   result.
3. Repeated stretches return to their documents and the words in them are removed.

Rows are told apart by id and text. A row that occurs twice is two rows, so all its
windows are repeats. Null and empty texts have no words; texts shorter than a window
are kept. Null ids are allowed. Columns other than id and text are not read. An empty
table gives no row. Every occurrence is removed, none is kept.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tablepulse.session import scratch_dir

from .arrays import WORD, bounded_batches, rolling, word_hashes

SEED_WORDS = 8
BUCKET_ROWS = 1 << 14

_WORD = re.compile(WORD)
_KEY = ("doc_id", "_hash")


def super_kmers(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser, first window and number of windows of each super-k-mer."""
    seed = min(SEED_WORDS, size)
    values = rolling(hashes, seed)
    width = size - seed + 1
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)
    # Place of the smallest value among `reach` values from each place on, doubled
    # until it spans the window; the first of equals wins.
    best, reach = np.arange(len(values)), 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = best[:-step], best[step:]
        best = np.where(values[left] <= values[right], left, right)
        reach += step
    first = np.flatnonzero(np.diff(best[:count], prepend=-1))
    number = np.diff(first, append=count)
    return values[best[first]].view(np.int64), first.astype(np.int32), number.astype(np.int32)


def _lists(values: np.ndarray, begin: np.ndarray) -> pa.ListArray:
    """Lists that begin at these places of the values."""
    offsets = np.append(begin, len(values)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def _places(docs: DataFrame, size: int, kind: str) -> DataFrame:
    """Super-k-mers of all documents, one row a document and minimiser, without text."""

    def find(batches):
        for batch in batches:
            found = [super_kmers(h, size) for h in word_hashes(batch.column(2).to_pylist())]
            if not found:
                continue
            owner = np.repeat(np.arange(len(found)), [len(row[0]) for row in found])
            minimiser, first, number = (np.concatenate(column) for column in zip(*found))
            order = np.lexsort((first, minimiser, owner))
            owner, minimiser = owner[order], minimiser[order]
            fresh = np.ones(len(owner), bool)
            fresh[1:] = (owner[1:] != owner[:-1]) | (minimiser[1:] != minimiser[:-1])
            begin = np.flatnonzero(fresh)
            rows = pa.array(owner[begin])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array(minimiser[begin]),
                    _lists(first[order], begin),
                    _lists(number[order], begin),
                ],
                [*_KEY, "minimiser", "firsts", "numbers"],
            )

    return docs.mapInArrow(
        find,
        f"doc_id {kind}, _hash long, minimiser long, firsts array<int>, numbers array<int>",
    )


def _join_key(left: DataFrame, right: DataFrame):
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["_hash"] == right["_hash"])


def _words(batches):
    """The words of each document joined by one space, and how many."""
    for batch in batches:
        words = [_WORD.findall(text) if text else [] for text in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(at) for at in (0, 1, 3)),
                pa.array([" ".join(row) for row in words], pa.string()),
                pa.array([len(row) for row in words], pa.int64()),
            ],
            [*_KEY, "cuts", "packed", "n_words"],
        )


def _offsets(packed: str) -> tuple[list[int], list[int]]:
    """Start and end of each word of a packed string."""
    words = packed.split(" ")
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    return (ends - lengths).tolist(), ends.tolist()


def _cutter(size: int, hot: bool):
    """The packed strings of the super-k-mers in hot buckets, or in all others."""

    def cut(batches):
        for batch in batches:
            rows = []
            texts, cuts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for at, (packed, places) in enumerate(zip(texts, cuts, strict=True)):
                starts, ends = _offsets(packed)
                for place in places:
                    if place["hot"] != hot:
                        continue
                    strings: dict[str, list[int]] = {}
                    for first, number in zip(place["firsts"], place["numbers"], strict=True):
                        text = packed[starts[first] : ends[first + number + size - 2]]
                        strings.setdefault(text, []).append(first)
                    rows += [(at, place["minimiser"], f, text) for text, f in strings.items()]
            owner, *columns = zip(*rows, strict=True) if rows else [()] * 4
            owner = pa.array(owner, pa.int64())
            kinds = (pa.int64(), pa.list_(pa.int32()), pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(owner),
                    batch.column(1).take(owner),
                    *(pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)),
                ],
                [*_KEY, "minimiser", "firsts", "packed"],
            )

    return cut


def windows_of(packed: str, size: int) -> list[str]:
    starts, ends = _offsets(packed)
    return [packed[starts[at] : ends[at + size - 1]] for at in range(len(starts) - size + 1)]


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ascending ranges with those that touch joined."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def repeated_stretches(number: dict[str, int], size: int) -> dict[str, list[tuple[int, int]]]:
    """For each super-k-mer of a bucket, the word ranges covered by repeated windows.

    ``number`` tells how often each one occurs.
    """
    windows = sorted(
        (window, packed, at)
        for packed in number
        for at, window in enumerate(windows_of(packed, size))
    )
    hits: dict[str, list[int]] = {packed: [] for packed in number}
    for here, (window, packed, at) in enumerate(windows):
        if (
            number[packed] > 1
            or (here and windows[here - 1][0] == window)
            or (here + 1 < len(windows) and windows[here + 1][0] == window)
        ):
            hits[packed].append(at)
    return {
        packed: merged([(at, at + size) for at in places]) for packed, places in hits.items()
    }


def _counter(size: int, kind: pa.DataType):
    """Repeated stretches of one bucket after the other; rows come sorted by minimiser."""

    def settle(rows):
        number: dict[str, int] = {}
        for *_, firsts, packed in rows:
            number[packed] = number.get(packed, 0) + len(firsts)
        if sum(number.values()) == 1:
            return
        found = repeated_stretches(number, size)
        for doc_id, key, _, firsts, packed in rows:
            here = [(at + start, at + end) for at in firsts for start, end in found[packed]]
            for start, end in merged(here):
                yield doc_id, key, start, end

    def table(rows):
        columns = zip(*rows, strict=True) if rows else [()] * 4
        kinds = (kind, pa.int64(), pa.int32(), pa.int32())
        arrays = [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, [*_KEY, "start", "end"])

    def count(batches):
        bucket: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if bucket and bucket[0][2] != row[2]:
                    out += settle(bucket)
                    bucket = []
                bucket.append(row)
            yield table(out)
        yield table(list(settle(bucket)))

    return count


def _hot_stretches(hot: DataFrame, size: int, kind: str) -> DataFrame:
    """The same for buckets too large for one task: windows counted as rows."""

    def spread(batches):
        for batch in batches:
            rows = [
                (at, first + inside, window)
                for at, (firsts, packed) in enumerate(
                    zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
                )
                for inside, window in enumerate(windows_of(packed, size))
                for first in firsts
            ]
            owner, start, window = zip(*rows, strict=True) if rows else [()] * 3
            owner = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(owner),
                    batch.column(1).take(owner),
                    pa.array(start, pa.int32()),
                    pa.array(window, pa.string()),
                ],
                [*_KEY, "start", "window"],
            )

    windows = hot.select(*_KEY, "firsts", "packed").mapInArrow(
        spread, f"doc_id {kind}, _hash long, start int, window string"
    )
    repeats = windows.groupBy("window").count().where("count > 1").select("window")
    return windows.join(repeats, "window", "left_semi").select(
        *_KEY, "start", (F.col("start") + size).alias("end")
    )


def _keep(batches):
    for batch in batches:
        texts, removed = [], []
        packs, ranges = batch.column(1).to_pylist(), batch.column(3).to_pylist()
        for packed, stretches in zip(packs, ranges, strict=True):
            if not stretches:
                texts.append(packed)
                removed.append(0)
                continue
            words = packed.split(" ")
            kept = np.ones(len(words), bool)
            for stretch in stretches:
                kept[stretch["start"] : stretch["end"]] = False
            texts.append(" ".join(words[at] for at in np.flatnonzero(kept)))
            removed.append(int(len(words) - kept.sum()))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(2),
                pa.array(removed, pa.int64()),
                pa.array(texts, pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "kept"],
        )


def remove_repeats(docs: DataFrame, size: int = 35) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and the ``kept`` words joined by one space."""
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("_hash"), "text")

    places = _places(rows, size, kind)
    shared = (
        places.groupBy("minimiser")
        .agg(F.sum(F.size("firsts")).alias("number"), F.count(F.lit(1)).alias("rows"))
        .where("number > 1")
        .select("minimiser", (F.col("rows") > BUCKET_ROWS).alias("hot"))
    )
    place = F.struct("minimiser", "firsts", "numbers", "hot")
    cuts = places.join(shared, "minimiser").groupBy(*_KEY).agg(F.collect_set(place).alias("cuts"))
    with_cuts = rows.join(cuts, _join_key(rows, cuts), "left").select(
        rows["doc_id"], rows["_hash"], rows["text"], cuts["cuts"]
    )
    struct = (
        "array<struct<minimiser: long, firsts: array<int>, numbers: array<int>, hot: boolean>>"
    )
    schema = f"doc_id {kind}, _hash long, cuts {struct}, packed string, n_words long"
    path = scratch_dir(spark)
    with_cuts.mapInArrow(_words, schema).write.option("compression", "zstd").parquet(path)
    stored = spark.read.parquet(path)

    touched = stored.where("cuts IS NOT NULL")
    some_hot = touched.where(F.exists("cuts", lambda cut: cut["hot"]))
    pieces, hot_pieces = (
        some.select(*_KEY, "packed", "cuts").mapInArrow(
            _cutter(size, hot),
            f"doc_id {kind}, _hash long, minimiser long, firsts array<int>, packed string",
        )
        for some, hot in ((touched, False), (some_hot, True))
    )
    cold = (
        pieces.repartition("minimiser")
        .sortWithinPartitions("minimiser")
        .mapInArrow(
            _counter(size, to_arrow_type(docs.schema["doc_id"].dataType)),
            f"doc_id {kind}, _hash long, start int, end int",
        )
    )
    stretches = cold.unionByName(_hot_stretches(hot_pieces, size, kind))
    found = stretches.groupBy(*_KEY).agg(F.collect_set(F.struct("start", "end")).alias("stretches"))
    joined = touched.join(found, _join_key(touched, found), "left").select(
        touched["doc_id"], touched["packed"], touched["n_words"], found["stretches"]
    )
    result = f"doc_id {kind}, n_words long, n_removed long, kept string"
    untouched = stored.where("cuts IS NULL").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("packed").alias("kept")
    )
    return joined.mapInArrow(_keep, result).unionByName(untouched)
