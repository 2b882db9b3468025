"""Phrase collocations by dynamic itemset counting.

Documents are dealt into ``shards`` by a hash. Each step scans one shard, the next in a
cycle, and counts phrases of all lengths that are active: single words from the first
step on, a longer phrase from the step after both of its subphrases (without its last
and without its first word) reached the threshold. A phrase is counted for one full
cycle, so its count is that of the whole corpus; with the cycle it is complete, and
dropped if it stayed below. Steps end when no phrase is active any more. A phrase that
reaches the threshold in the end has subphrases that do, so none is missed.

The running counts are a table, not a broadcast: a step's counts are summed in tasks,
by shuffle, and with those of the phrases that are still active. What goes to the tasks
is an array of ``slots`` bytes whatever the corpus: for each hash the step in which a
phrase of that hash reached the threshold. Two phrases that share a slot only let
longer ones start early, but none before its subphrases are counted themselves; these
too are counted for one full cycle from there on, so results do not depend on it. Phrases travel as text, their 64-bit hashes are used only
within a run of a few MB to group equal ones.

Each scan reads the texts again: a stored table is read as often as there are steps, at
most ``shards * longest`` of which each uses one shard.

Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends, and these
into words at spaces and tabs. Everything is counted per language; null is ``und``.
Null and empty texts hold no phrase. Very long texts are cut between words, the last
words before the cut go along, so phrases across it count. Repeated rows count each.
Other columns but ``doc_id``, which helps to deal, are not read. An empty table gives
no row.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablepulse.session import scratch_dir
from tablepulse.sources.writers import delete_folder

from .arrays import bounded_batches, mix, runs

THRESHOLD = 100
LONGEST = 5
FIRST = 2000
SHARE = 100
SHARDS = 2
SLOTS = 1 << 24
RUN = 1 << 22
BLOCK = 1 << 18  # bytes hashed at once
ROWS = 1 << 15  # phrases made at once
NEVER = 255
UNKNOWN = "und"

_BITMAP = 32768  # bits in one of Spark's bitmaps
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_DELIMITER = re.compile(rb"[.,;:!?\x0a-\x0d\x20\x09]")
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(_BREAKS)] = 2

_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, _U), np.ones(1, _U))


def _powers_to(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    global _powers
    if len(_powers[0]) < size:
        grown = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            row = np.full(size, base, _U)
            row[0] = 1
            grown.append(np.multiply.accumulate(row))
        _powers = tuple(grown)
    return _powers


@functools.lru_cache(maxsize=1024)
def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _words_back(text: bytes, at: int, count: int) -> int:
    """Where the last ``count`` words of the piece before ``at`` begin."""
    for _ in range(count):
        while at and _KIND[text[at - 1]] == 1:
            at -= 1
        while at and not _KIND[text[at - 1]]:
            at -= 1
    return at


def parts(text: bytes, longest: int) -> Iterator[tuple[bytes, int]]:
    """A text in parts of about ``RUN`` bytes, and how many bytes of each were in the one before."""
    begin, at = 0, 0
    while True:
        found = _DELIMITER.search(text, at + RUN) if len(text) - at > RUN else None
        end = found.start() if found else len(text)
        yield text[begin:end], at - begin
        if end == len(text):
            return
        begin, at = _words_back(text, end, longest - 1), end


class Words:
    """The words of several texts: hash, place, piece and language."""

    def __init__(self, texts: list[bytes], langs: list[str], skips: list[int]):
        self.text = b"\n".join(texts).lower()
        codes = np.frombuffer(self.text, np.uint8)
        kinds = _KIND[codes]
        edges = np.flatnonzero(np.diff(kinds == 0, prepend=False, append=False))
        self.starts, self.ends = edges[::2], edges[1::2]
        firsts = np.cumsum([0, *(len(text) + 1 for text in texts)])[:-1]
        self.owner = np.searchsorted(firsts, self.starts, "right") - 1
        self.own = self.starts >= (firsts + np.array(skips))[self.owner] if len(edges) else self.starts > 0
        self.langs = np.array(langs, object)
        seeds = np.array([_seed(lang) for lang in langs], _U)
        self.hashes = np.empty(len(self.starts), _U)
        for begin, end in self._blocks():
            plain = mix(self._sums(codes, begin, end))
            self.hashes[begin:end] = mix(plain ^ seeds[self.owner[begin:end]])
        breaks = np.flatnonzero(kinds == 2)
        piece = np.searchsorted(breaks, self.starts)
        self.joined = piece[1:] == piece[:-1]  # with the word that follows
        gaps = self.starts[1:] - self.ends[:-1]
        self.plain = b"\t" not in self.text and not (gaps[self.joined] > 1).any()

    def _blocks(self) -> Iterator[tuple[int, int]]:
        """The words in blocks of about ``BLOCK`` bytes, at least one word each."""
        begin = 0
        while begin < len(self.starts):
            end = int(np.searchsorted(self.ends, self.starts[begin] + BLOCK, "right"))
            yield begin, max(end, begin + 1)
            begin = max(end, begin + 1)

    def _sums(self, codes: np.ndarray, begin: int, end: int) -> np.ndarray:
        """For each word of a block its bytes times the powers of the base."""
        first = self.starts[begin]
        block = codes[first : self.ends[end - 1]]
        powers, inverse = _powers_to(len(block))
        sums = np.zeros(len(block) + 1, _U)
        np.cumsum((block + _U(1)) * powers[: len(block)], out=sums[1:])
        starts, ends = self.starts[begin:end] - first, self.ends[begin:end] - first
        return (sums[ends] - sums[starts]) * inverse[starts]

    def phrase_hashes(self, at: np.ndarray, size: int) -> np.ndarray:
        if size == 1:
            return self.hashes[at]
        total = np.zeros(len(at), _U)
        for place, power in enumerate(_powers_to(size)[0][:size]):
            total += self.hashes[at + place] * power
        return mix(total)

    def phrases(self, at: np.ndarray, size: int) -> list[bytes]:
        bounds = zip(self.starts[at].tolist(), self.ends[at + size - 1].tolist(), strict=True)
        if self.plain:
            return [self.text[begin:end] for begin, end in bounds]
        return [b" ".join(self.text[begin:end].split()) for begin, end in bounds]

    def active(
        self, reached: np.ndarray, step: int, shards: int, longest: int
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length the places of active phrases and the steps before their first."""
        mask = _U(len(reached) - 1)
        at = np.arange(len(self.starts))
        subphrase = reached[(self.hashes & mask).astype(np.int64)]
        if step < shards:
            yield 1, at[self.own], np.full(int(self.own.sum()), -1, np.int16)
        for size in range(2, longest + 1):
            at = at[at + size - 1 < len(self.starts)]
            if not len(at):
                return
            together = self.joined[at + size - 2]
            later = np.maximum(subphrase[at], subphrase[at + 1])
            known = together & (later < step)
            at, later = at[known], later[known].astype(np.int16)
            if not len(at):
                return
            hashes = self.phrase_hashes(at, size)
            counted = (later + shards >= step) & self.own[at + size - 1]
            yield size, at[counted], later[counted]
            # Another phrase may have reached the slot before this one was counted itself.
            spot = reached[(hashes & mask).astype(np.int64)]
            subphrase = np.full(len(self.starts), NEVER, np.uint8)
            subphrase[at] = np.maximum(spot, later.astype(np.uint8))


def _texts(batches, longest: int) -> Iterator[Words]:
    """Arrow batches of language and text as runs of words."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        for begin, end in runs([len(text) for text in texts], RUN):
            if end > begin + 1:
                yield Words(texts[begin:end], langs[begin:end], [0] * (end - begin))
                continue
            for part, skip in parts(texts[begin], longest):
                yield Words([part], [langs[begin]], [skip])


_COUNTS = "lang string, phrase binary, n_words int, since int, n long"


def _rows(langs: np.ndarray, phrases: list[bytes], size: int, since: np.ndarray, n: np.ndarray):
    return pa.RecordBatch.from_arrays(
        [
            pa.array(langs, pa.string()),
            pa.array(phrases, pa.binary()),
            pa.array(np.full(len(n), size, np.int32)),
            pa.array((since + 1).astype(np.int32)),
            pa.array(n.astype(np.int64)),
        ],
        ["lang", "phrase", "n_words", "since", "n"],
    )


def _counts(
    words: Words, known: np.ndarray, step: int, shards: int, longest: int
) -> Iterator[pa.RecordBatch]:
    """Counts of the active phrases of a run, ``ROWS`` at a time."""
    for size, at, since in words.active(known, step, shards, longest):
        if size == 1:
            owners, n = np.unique(words.owner[at], return_counts=True)
            yield _rows(words.langs[owners], [b""] * len(owners), 0, -np.ones(len(owners)), n)
        _, first, n = np.unique(
            words.phrase_hashes(at, size), return_index=True, return_counts=True
        )
        for begin in range(0, len(first), ROWS):
            some = first[begin : begin + ROWS]
            found = at[some]
            langs = words.langs[words.owner[found]]
            phrases = words.phrases(found, size)
            yield _rows(langs, phrases, size, since[some], n[begin : begin + ROWS])


def _scan(shard: DataFrame, reached: Broadcast, step: int, shards: int, longest: int) -> DataFrame:
    """Counts of the active phrases of one shard; the empty phrase counts all words."""

    def count(batches):
        known = np.frombuffer(reached.value, np.uint8)
        for words in _texts(batches, longest):
            if len(words.starts):
                yield from _counts(words, known, step, shards, longest)

    return shard.mapInArrow(count, _COUNTS)


def _slots(phrases: DataFrame, slots: int) -> np.ndarray:
    """The slots of the phrases, as Spark's bitmaps: at most ``slots`` bits come to the driver."""

    def place(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            langs = batch.column(0).to_pylist()
            words = Words(texts, langs, [0] * len(texts))
            sizes = batch.column(2).to_numpy()
            first = np.cumsum(sizes) - sizes
            found = np.zeros(len(texts), _U)
            for size in np.unique(sizes).tolist():
                found[sizes == size] = words.phrase_hashes(first[sizes == size], size)
            spot = (found & _U(slots - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(spot)], ["slot"])

    spots = phrases.select("lang", "phrase", "n_words").mapInArrow(place, "slot long")
    number = F.col("slot") + 1
    bitmaps = spots.groupBy(F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
    )
    found = [np.empty(0, np.int64)]
    for bucket, bits in bitmaps.collect():
        places = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))
        found.append((bucket - 1) * _BITMAP + places)
    return np.concatenate(found)


def count_phrases(
    docs: DataFrame,
    threshold: int = THRESHOLD,
    longest: int = LONGEST,
    shards: int = SHARDS,
    slots: int = SLOTS,
) -> DataFrame:
    """``lang``, ``phrase``, ``n_words``, ``n`` of all phrases that occur ``threshold`` times.

    The row with the empty phrase (``n_words`` 0) holds the number of words of a language.
    """
    if shards * longest >= NEVER:
        raise ValueError(f"shards times longest must be below {NEVER}")
    spark = docs.sparkSession
    bounded_batches(spark)
    folder = scratch_dir(spark)
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).alias("shard"),
    )
    reached = np.full(slots, NEVER, np.uint8)
    counted = spark.createDataFrame([], _COUNTS)
    step, last = 0, 0
    while step < shards or step <= last + shards:
        shard = texts.where(F.col("shard") == step % shards).select("lang", "text")
        shared = spark.sparkContext.broadcast(reached.tobytes())
        found = _scan(shard, shared, step, shards, longest)
        summed = (
            counted.unionByName(found)
            .groupBy("lang", "phrase", "n_words", "since")
            .agg(F.sum("n").alias("n"))
        )
        is_done = F.col("since") + (shards - 1) <= step
        kept = (F.col("n") >= threshold) | (F.col("n_words") == 0) | ~is_done
        path = f"{folder}/step={step}"
        summed.where(kept).withColumn("done", is_done).write.partitionBy("done").parquet(path)
        shared.destroy()
        written = spark.read.schema(f"{_COUNTS}, done boolean").parquet(path)
        is_new = F.col("n_words").between(1, longest - 1) & (F.col("n") >= threshold)
        spots = _slots(written.where(is_new), slots)
        fresh = spots[reached[spots] == NEVER]
        reached[fresh] = step
        if len(fresh):
            last = step
        if step:
            delete_folder(spark, f"{folder}/step={step - 1}/done=false")
        counted = written.where("not done").drop("done")
        step += 1
    result = spark.read.schema(f"{_COUNTS}, done boolean, step int").parquet(folder)
    return result.where("done").select(
        "lang", F.col("phrase").cast("string").alias("phrase"), "n_words", "n"
    )


def rank_collocations(counts: DataFrame, first: int = FIRST, share: int = SHARE) -> DataFrame:
    """The first collocations of each language by the score of their weakest cut.

    ``score`` is floor(1000 a n / (l r)) in exact decimals; the lowest cut counts, of
    equal ones that after the fewest words. A candidate within a longer one that has at
    least ``share`` percent of its count is left out.
    """
    known = counts.where("n_words > 0").select("lang", "phrase", "n")
    totals = counts.where("n_words = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    words = F.split("phrase", " ")
    candidates = counts.where("n_words > 1").select(
        "lang", "phrase", F.col("n_words").alias("size"), F.col("n").alias("a"), words.alias("words")
    )

    def joined(start, length):
        return F.array_join(F.slice("words", start, length), " ")

    each = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = candidates.select("*", each).select(
        "lang",
        "phrase",
        "a",
        "k",
        joined(F.lit(1), F.col("k")).alias("left"),
        joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
    )
    lefts = known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    rights = known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    wide = "decimal(38,0)"
    over = F.lit(1000).cast(wide) * F.col("a").cast(wide) * F.col("n").cast(wide)
    under = F.col("l").cast(wide) * F.col("r").cast(wide)
    scored = (
        cuts.join(lefts, ["lang", "left"])
        .join(rights, ["lang", "right"])
        .join(totals, "lang")
        .withColumns({"over": over, "under": under})
        .withColumn("score", F.expr("over div under"))
    )
    weakest = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut")
    )
    inside = candidates.where("size > 2").select(
        "lang",
        "a",
        F.explode(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(2), F.col("size") - 1),
                    lambda length: F.transform(
                        F.sequence(F.lit(1), F.col("size") - length + 1),
                        lambda start: joined(start, length),
                    ),
                )
            )
        ).alias("phrase"),
    )
    longer = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    free = weakest.join(longer, ["lang", "phrase"], "left").where(
        F.coalesce(F.lit(100) * F.col("longer") < F.lit(share) * F.col("cut.a"), F.lit(True))
    )
    order = [F.desc("cut.score"), F.desc("cut.a"), F.asc("phrase")]
    # A language may hold most phrases: each slice of it offers its first ones.
    slices = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    whole = Window.partitionBy("lang").orderBy(*order)
    offered = free.withColumn("rank", F.row_number().over(slices)).where(F.col("rank") <= first)
    ranked = offered.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= first)
    return ranked.select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        *(F.col(f"cut.{name}").cast("long").alias(name) for name in ("a", "l", "r", "n", "score")),
    )


def collocations(
    docs: DataFrame,
    threshold: int = THRESHOLD,
    longest: int = LONGEST,
    first: int = FIRST,
    share: int = SHARE,
    shards: int = SHARDS,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, its counts and score: the first of every language."""
    return rank_collocations(count_phrases(docs, threshold, longest, shards), first, share)
