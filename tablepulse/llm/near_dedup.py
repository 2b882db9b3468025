"""Near-duplicate documents by Order MinHash.

Each of ``SKETCHES`` hash functions picks the ``PICKED`` smallest five-word k-mers of
a text, equal k-mers told apart by their occurrence, and keeps them in text order, so
that a sketch agrees for texts with the same k-mers in the same order: it is sensitive
to edit similarity, not only to the set. Texts that share a sketch are candidates. They
are verified by banded alignment of their words: similar are texts whose edit distance
in words is at most 20 percent of the longer one. Classes are what links connect.

How many pairs are compared, always in proportion to the rows:

* Copies of a text are one node from the start, found by hash with map-side sums.
* In a bucket (texts sharing a sketch) all are compared with one pivot, the text with
  the least hash, so that the buckets of one group tend to have the same pivot. Each text
  meets the least pivot of its buckets first, the others only if they stay in another class:
  a group of n texts has about n links then, not one for each text and pivot.
* If that leaves a bucket in several classes, its texts of different classes are
  compared, all in buckets of up to ``SMALL`` texts, with a second pivot in larger
  ones, another for each bucket. No pair is compared within one class.
* What is then still apart in a larger bucket is joined by its rarest words: similar texts
  have all words but a fifth in common, so they share one of that fifth and one more, taken in
  the same order of all words. How rare a word is, is taken from about ``SAMPLE`` texts; links
  do not depend on it. Words that only texts of one class or of other lengths have are left out,
  a pair comes from about one of the words it shares, and only if their numbers of words, in all
  and in each of ``BINS`` bins, allow a link. A row of that join has one word of a text; what else
  it carries of the text (its bins, its ``LEAST`` least words) is bounded, however long the text.

So a link is missed only if two texts share no sketch (at an edit similarity of 0.8, the
least that counts, fewer than one in ten; at 0.85 one in 50 or fewer). The last step tests
the pairs of texts that share a rare word, not all pairs of a bucket: in a group of texts that
stay apart though most of their words are common, these tests grow with the square of the group.

Texts travel only for candidates. Copies join by text hash and id, so that a hot text
is spread. Tables in the shared scratch folder cut the lineage between steps.

Null texts count as empty. Texts without a word have a sketch of nothing and match
equal texts only. Texts with fewer than five words are one k-mer. Null ids are allowed;
a class is named by its least id, null if it has none. Repeated rows are copies. Ties
of hashes go to the first place in the text. Other columns are not read, an empty table
gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablepulse.session import scratch_dir

from .arrays import bounded_batches, mix, rolling, word_hashes
from .components import components

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 64
PICKED = 2
SMALL = 8
BINS = 1024
DEEP = 16
LEAST = 16
BAND = 1.26
SAMPLE = 2000
FREQUENT = 1 << 16
CELLS = 1 << 16

_U = np.uint64
_ODD = mix(np.arange(1, 2 * SKETCHES + 1, dtype=np.uint64)) | _U(1)
_XOR, _TIMES = _ODD[:-1:2, None], _ODD[1::2, None]
_LAST = _U(2**64 - 1)
_TEXT = ("t1", "t2")


def occurrence_labels(shingles: np.ndarray) -> np.ndarray:
    """Each k-mer hash mixed with the number of equal ones before it."""
    order = np.argsort(shingles, kind="stable")
    ordered = shingles[order]
    fresh = np.append(True, ordered[1:] != ordered[:-1])
    begin = np.flatnonzero(fresh)
    rank = np.arange(len(ordered)) - np.repeat(begin, np.diff(begin, append=len(ordered)))
    labels = np.empty_like(shingles)
    labels[order] = mix(ordered + rank.astype(np.uint64) * _ODD[0])
    return labels


def order_minhash(words: np.ndarray) -> np.ndarray:
    """The sketches of a text given by its word hashes; none for a text without words."""
    if not len(words):
        return np.empty(0, np.int64)
    shingles = rolling(words, min(SHINGLE, len(words)))
    labels = occurrence_labels(shingles)
    width = min(PICKED, len(shingles))
    picked = np.empty((SKETCHES, width), np.uint64)
    some = max(1, CELLS // len(shingles))
    for at in range(0, SKETCHES, some):
        values = (labels ^ _XOR[at : at + some]) * _TIMES[at : at + some]
        every = np.arange(len(values))
        places = np.empty((len(values), width), np.intp)
        for turn in range(width):
            places[:, turn] = values.argmin(axis=1)
            values[every, places[:, turn]] = _LAST
        places.sort(axis=1)
        picked[at : at + some] = shingles[places]
    keys = np.arange(SKETCHES, dtype=np.uint64)
    for column in picked.T:
        keys = (keys * _ODD[1]) ^ column
        keys ^= keys >> _U(29)
    return mix(keys).view(np.int64)


def word_bins(words: np.ndarray) -> np.ndarray:
    """How many words fall into each bin, at most ``DEEP``.

    One bit a bin for each number, set if the bin has as many words: most texts need few numbers.
    """
    counts = np.bincount((words % _U(BINS)).astype(np.int64), minlength=BINS)
    numbers = np.arange(1, min(DEEP, int(counts.max())) + 1)
    return np.packbits(counts >= numbers[:, None], axis=1).reshape(-1).view(np.int32)


def _budget(a: str, b: str) -> Column:
    """The most edits between similar texts of these numbers of words."""
    return F.floor(F.lit(1 - SIMILARITY) * F.greatest(a, b) + F.lit(1e-9))


def may_be_similar(a: str, b: str) -> Column:
    """False only if numbers of words rule out that two texts are similar.

    The bins, cut at ``DEEP`` or not, differ by no more than the words that only one text has.
    """
    words = F.col(f"{a}.n_words"), F.col(f"{b}.n_words")
    budget = _budget(f"{a}.n_words", f"{b}.n_words")
    none, low = F.lit(0), F.lit(2**32 - 1)
    differences = F.zip_with(
        f"{a}.bins",
        f"{b}.bins",
        lambda x, y: F.bit_count(
            F.coalesce(x, none).bitwiseXOR(F.coalesce(y, none)).cast("long").bitwiseAND(low)
        ),
    )
    apart = F.aggregate(differences, F.lit(0), lambda total, one: total + one)
    room = words[0] + words[1] - 2 * (F.greatest(*words) - budget)
    return (F.abs(words[0] - words[1]) <= budget) & (apart <= room)


def _shared_words(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the common bag of words."""
    left, left_counts = np.unique(a, return_counts=True)
    right, right_counts = np.unique(b, return_counts=True)
    _, x, y = np.intersect1d(left, right, assume_unique=True, return_indices=True)
    return int(np.minimum(left_counts[x], right_counts[y]).sum())


def edit_distance(a: np.ndarray, b: np.ndarray, budget: int) -> int | None:
    """Edit distance of two sequences if it is within the budget, by banded alignment.

    For each number of edits the furthest place on each diagonal is kept; diagonals
    from which the end is out of reach are left out.
    """
    if abs(len(a) - len(b)) > budget or max(len(a), len(b)) - _shared_words(a, b) > budget:
        return None
    same = min(len(a), len(b))
    differ = np.flatnonzero(a[:same] != b[:same])
    head = int(differ[0]) if len(differ) else same
    x, y = a[head:].tolist(), b[head:].tolist()
    n, m = len(x), len(y)
    goal = n - m
    reached = {0: 0}
    for edits in range(budget + 1):
        room = budget - edits
        following: dict[int, int] = {}
        for diagonal, place in reached.items():
            limit = min(n, m + diagonal)
            while place < limit and x[place] == y[place - diagonal]:
                place += 1
            if diagonal == goal and place == n:
                return edits
            for other, step in ((diagonal, 1), (diagonal + 1, 1), (diagonal - 1, 0)):
                to = place + step
                if (
                    abs(other - goal) < room
                    and other <= to <= min(n, m + other)
                    and to > following.get(other, -1)
                ):
                    following[other] = to
        reached = following
    return None


def _once(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The k-mers that occur once in a text, and where."""
    values, first, count = np.unique(
        rolling(words, SHINGLE), return_index=True, return_counts=True
    )
    return values[count == 1], first[count == 1]


def anchored_distance(a: np.ndarray, b: np.ndarray) -> int:
    """Cost of one alignment: through common k-mers that ascend in both texts.

    Between neighbouring anchors the words of the first one match and the rest is
    replaced, so this is never less than the edit distance.
    """
    left, left_at = _once(a)
    right, right_at = _once(b)
    _, x, y = np.intersect1d(left, right, assume_unique=True, return_indices=True)
    order = np.argsort(left_at[x])
    i, j = left_at[x][order], right_at[y][order]
    if len(j):
        rising = np.append(True, j[1:] > np.maximum.accumulate(j)[:-1])
        i, j = i[rising], j[rising]
    if not len(j):
        return max(len(a), len(b))
    di, dj = np.diff(i, append=len(a)), np.diff(j, append=len(b))
    steps = np.maximum(di, dj) - np.minimum(SHINGLE, np.minimum(di, dj))
    return int(max(i[0], j[0]) + steps.sum())


def similar(a: np.ndarray, b: np.ndarray, threshold: float = SIMILARITY) -> bool:
    """Whether the edit distance is within the budget of the threshold.

    Lengths and common words can rule it out and one alignment can prove it; only what
    they leave open is aligned in full.
    """
    longer = max(len(a), len(b))
    budget = int((1 - threshold) * longer + 1e-9)
    if abs(len(a) - len(b)) > budget or longer - _shared_words(a, b) > budget:
        return False
    return anchored_distance(a, b) <= budget or edit_distance(a, b, budget) is not None


def text_hashes(text: str = "text") -> tuple[Column, Column]:
    """128 bits that stand for a text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return F.xxhash64(whole).alias("t1"), F.xxhash64(F.lit(1), whole).alias("t2")


def _sketches(docs: DataFrame, kind: str) -> DataFrame:
    def sketch(batches):
        for batch in batches:
            found = list(word_hashes(batch.column(3).to_pylist()))
            keys = [order_minhash(words) for words in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(at) for at in range(3)),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["doc_id", *_TEXT, "sketches"],
            )

    return docs.select("doc_id", *text_hashes(), "text").mapInArrow(
        sketch, f"doc_id {kind}, t1 long, t2 long, sketches array<long>"
    )


def _verify(pairs: DataFrame) -> DataFrame:
    """Links among pairs of (name, text)."""

    def align(batches):
        cache: tuple[str | None, np.ndarray] = ("", np.empty(0, np.uint64))
        for batch in batches:
            names, others = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            left = word_hashes(batch.column(1).to_pylist())
            good = []
            pivots = batch.column(3)
            for at, words in enumerate(left):
                if others[at] != cache[0]:
                    cache = (others[at], next(word_hashes([pivots[at].as_py()])))
                if names[at] != others[at] and similar(words, cache[1]):
                    good.append(at)
            rows = batch.take(pa.array(good, pa.int64()))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2)], ["a", "b"])

    return pairs.select("a", "a_text", "b", "b_text").mapInArrow(align, "a string, b string")


def _frequent_words(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words, ascending, of some texts, and how often they occur there."""

    def count(batches):
        for batch in batches:
            labels = [occurrence_labels(words) for words in word_hashes(batch.column(0).to_pylist())]
            found, n = np.unique(np.concatenate([np.empty(0, _U), *labels]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["word", "n"])

    share = max(1, texts.count() // SAMPLE)
    some = texts.where(F.pmod("t1", F.lit(share)) == 0).select("text")
    counts = some.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    rows = counts.where("n > 1").orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    words = np.array([row["word"] for row in rows], np.int64).view(_U)
    order = np.argsort(words)
    return words[order], np.array([row["n"] for row in rows], np.int64)[order]


def rarest_words(words: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One word more than a similar text may lack, the rarest first.

    Equal words are told apart by their occurrence. A similar text has all words but those
    of the budget, so the first common word in one order of all words is among these in both.
    """
    labels = occurrence_labels(words)
    often = np.zeros(len(labels), np.int64)
    if len(frequent[0]):
        at = np.minimum(np.searchsorted(frequent[0], labels), len(frequent[0]) - 1)
        known = frequent[0][at] == labels
        often[known] = frequent[1][at[known]]
    size = int((1 - SIMILARITY) * len(labels) + 1e-9) + 1
    return labels[np.lexsort((labels, often))[:size]].view(np.int64)


def _rare_words(texts: DataFrame, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    def pick(batches):
        for batch in batches:
            found = list(word_hashes(batch.column(2).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(words) for words in found], pa.int32()),
                    pa.array([rarest_words(words, frequent) for words in found], pa.list_(pa.int64())),
                    pa.array([word_bins(words) for words in found], pa.list_(pa.int32())),
                ],
                ["t1", "root", "n_words", "words", "bins"],
            )

    return texts.select("t1", "root", "text").mapInArrow(
        pick, "t1 long, root string, n_words int, words array<long>, bins array<int>"
    )


def word_rows(rare: DataFrame) -> DataFrame:
    """A row for each rare word of a text that a text of another class and like length has too.

    Lengths of similar texts are in the same band or in neighbouring ones.
    """
    band = F.floor(F.log("n_words") / F.lit(float(np.log(BAND)))).alias("band")
    root = F.xxhash64("root").alias("root")
    spots = rare.select("t1", root, band, F.explode("words").alias("word"))
    near = Window.partitionBy("word").orderBy("band").rangeBetween(-1, 1)
    bands = spots.groupBy("word", "band").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    bands = bands.select("word", "band", F.min("x").over(near).alias("x"), F.max("y").over(near).alias("y"))
    spots = spots.join(bands.where("x <> y").select("word", "band"), ["word", "band"], "left_semi")
    shared = spots.groupBy("t1").agg(F.sort_array(F.collect_set("word")).alias("shared"))
    return rare.join(shared, "t1").select(
        "t1", root, "n_words", "bins", F.slice("shared", 1, LEAST).alias("least"), F.explode("shared").alias("word")
    )


def word_pairs(rare: DataFrame) -> DataFrame:
    """Each pair in different classes that shares a rare word and may be similar, once.

    It comes from the least word it shares, and from another only if that one is not among
    the least words of both texts.
    """
    texts = word_rows(rare)
    a, b = texts.alias("a"), texts.alias("b")
    least = F.array_min(F.array_intersect("a.least", "b.least"))
    apart = (
        (F.col("a.word") == F.col("b.word"))
        & (F.col("a.t1") < F.col("b.t1"))
        & (F.col("a.root") != F.col("b.root"))
        & F.coalesce(least >= F.col("a.word"), F.lit(True))
        & may_be_similar("a", "b")
    )
    return a.join(b, apart).select(F.col("a.t1").alias("a1"), F.col("b.t1").alias("b1")).distinct()


def _name(t1: str = "t1", t2: str = "t2") -> Column:
    return F.concat(F.lpad(F.hex(t1), 16, "0"), F.lpad(F.hex(t2), 16, "0"))


class _Search:
    """The tables of one run, each in a folder of its own."""

    def __init__(self, docs: DataFrame):
        self.docs, self.spark = docs, docs.sparkSession
        self.folder = scratch_dir(self.spark)
        self.kind = docs.schema["doc_id"].dataType.simpleString()

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def nodes(self) -> DataFrame:
        """One row a text: its sketches, and the least id among its copies."""
        rows = self.store(_sketches(self.docs, self.kind), "sketches")
        least = rows.groupBy(*_TEXT).agg(F.min("doc_id").alias("least"))
        same = (
            (rows["t1"] == least["t1"])
            & (rows["t2"] == least["t2"])
            & rows["doc_id"].eqNullSafe(least["least"])
        )
        # Repeated rows make a node twice, which changes no least or greatest hash.
        return self.store(rows.join(least, same, "left_semi"), "nodes")

    def texts(self, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
        """Hash, name and text of all that the pairs hold; later steps compare no others."""
        wanted = pairs.select(F.col("a1").alias("t1")).union(pairs.select("b1")).distinct()
        needed = nodes.join(wanted, "t1", "left_semi").select("doc_id", *_TEXT).distinct()
        texts = self.docs.select("doc_id", *text_hashes(), "text")
        same = (
            (texts["t1"] == needed["t1"])
            & (texts["t2"] == needed["t2"])
            & texts["doc_id"].eqNullSafe(needed["doc_id"])
        )
        found = texts.join(needed, same, "left_semi").select("t1", _name().alias("node"), "text")
        return self.store(found, "texts")

    def links(self, texts: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
        """Verified links among pairs of hashes ``a1``, ``b1``."""
        pairs = self.store(pairs, f"{name}_pairs")
        a = texts.select(F.col("t1").alias("a1"), F.col("node").alias("a"), F.col("text").alias("a_text"))
        b = texts.select(F.col("t1").alias("b1"), F.col("node").alias("b"), F.col("text").alias("b_text"))
        return self.store(_verify(pairs.join(a, "a1").join(b, "b1")).distinct(), f"{name}_links")

    def connected(self, roots: DataFrame, links: DataFrame, name: str) -> DataFrame:
        """The classes after further links, by the components of the classes that these connect."""
        left, right = roots.toDF("a", "a_root"), roots.toDF("b", "b_root")
        ends = links.join(left, "a", "left").join(right, "b", "left")
        between = ends.select(
            F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")
        ).distinct()
        tops = components(self.store(between, f"{name}_between"))
        tops = tops.select(F.col("node").alias("root"), F.col("root").alias("top"))
        known = roots.join(tops, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
        # A root is a node too, so it comes twice, with the same class.
        return self.store(known.union(tops).distinct(), f"{name}_roots")

    def candidates(self, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Pairs of a text and the pivot of its bucket; and the members of buckets of three or more."""
        # Dealt once, for the least of each bucket and for the join with it.
        members = nodes.select("t1", F.explode("sketches").alias("sketch")).repartition("sketch")
        buckets = (
            members.groupBy("sketch")
            .agg(F.min("t1").alias("b1"), F.max("t1").alias("_last"), F.count("*").alias("size"))
            .where("b1 <> _last")
        )
        shared = members.join(buckets.drop("_last"), "sketch")
        shared = self.store(shared.select("t1", "sketch", "b1", "size"), "shared")
        pairs = shared.where("t1 <> b1").select(F.col("t1").alias("a1"), "b1").distinct()
        pairs = self.store(pairs, "candidates")
        return pairs, shared.where("size > 2").select("t1", "sketch", "size")

    def classed(self, nodes: DataFrame, roots: DataFrame, *columns: str) -> DataFrame:
        """The class of every text, that of a text without links being its own."""
        named = nodes.select("t1", _name().alias("node"), *columns).distinct()
        return named.join(roots, "node", "left").select(
            "t1", F.coalesce("root", "node").alias("root"), *columns
        )

    def apart(self, nodes: DataFrame, pairs: DataFrame, roots: DataFrame) -> DataFrame:
        """The pairs of texts that are in different classes so far."""
        classes = self.classed(nodes, roots)
        a, b = classes.toDF("a1", "a_root"), classes.toDF("b1", "b_root")
        both = pairs.join(a, "a1").join(b, "b1")
        return both.where("a_root <> b_root").select("a1", "b1").distinct()

    def open_members(
        self, nodes: DataFrame, shared: DataFrame, roots: DataFrame, name: str, *columns: str
    ) -> DataFrame:
        """The members, with their classes, of buckets that hold more than one class."""
        members = self.store(shared.join(self.classed(nodes, roots, *columns), "t1"), name)
        spread = members.groupBy("sketch").agg(F.min("root").alias("x"), F.max("root").alias("y"))
        return members.join(spread.where("x <> y").select("sketch"), "sketch")

    def rest(self, nodes: DataFrame, shared: DataFrame, roots: DataFrame) -> DataFrame:
        """Pairs in different classes that share a bucket in which no pivot joined them."""
        open_members = self.open_members(nodes, shared, roots, "members")
        other = F.xxhash64("t1", "sketch")
        second = (
            open_members.where(F.col("size") > SMALL)
            .groupBy("sketch")
            .agg(F.min(F.struct(other.alias("order"), "t1", "root")).alias("pivot"))
            .select("sketch", "pivot.t1", "pivot.root")
        )
        few = open_members.where(F.col("size") <= SMALL).select("sketch", "t1", "root")
        a, b = open_members.alias("a"), few.unionByName(second).alias("b")
        apart = (F.col("a.sketch") == F.col("b.sketch")) & (F.col("a.root") != F.col("b.root"))
        first, last = F.least("a.t1", "b.t1"), F.greatest("a.t1", "b.t1")
        return a.join(b, apart).select(first.alias("a1"), last.alias("b1")).distinct()

    def remaining(
        self,
        nodes: DataFrame,
        texts: DataFrame,
        shared: DataFrame,
        roots: DataFrame,
        compared: DataFrame,
    ) -> DataFrame:
        """All pairs in different classes of large buckets that may be similar and were not compared so far."""
        large = shared.where(F.col("size") > SMALL)
        members = self.open_members(nodes, large, roots, "large_members")
        left = texts.join(members.select("t1", "root").distinct(), "t1").select("t1", "root", "text")
        left = self.store(left, "left")
        rare = self.store(_rare_words(left, _frequent_words(left)), "rare")
        return word_pairs(rare).join(compared, ["a1", "b1"], "left_anti")

    def met(self, texts: DataFrame, shared: DataFrame, links: DataFrame) -> DataFrame:
        """The links between texts that share a sketch."""
        ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
        named = texts.select("t1", "node").join(ends, "node", "left_semi").distinct()
        named = shared.join(named, "t1").groupBy("node").agg(F.collect_set("sketch").alias("sketches"))
        a, b = named.toDF("a", "a_sketches"), named.toDF("b", "b_sketches")
        both = links.join(a, "a").join(b, "b")
        return both.where(F.arrays_overlap("a_sketches", "b_sketches")).select("a", "b")

    def classes(self, nodes: DataFrame) -> DataFrame:
        """``node`` and ``root`` of every text that is linked to another."""
        pairs, shared = self.candidates(nodes)
        texts = self.texts(nodes, pairs)
        first = pairs.groupBy("a1").agg(F.min("b1").alias("b1"))
        roots = components(self.links(texts, first, "first"))
        others = self.apart(nodes, pairs, roots)
        roots = self.connected(roots, self.links(texts, others, "pivot"), "pivot")
        rest = self.store(self.rest(nodes, shared, roots), "apart")
        if rest.isEmpty():
            return roots
        roots = self.connected(roots, self.links(texts, rest, "rest"), "rest")
        compared = pairs.select(F.col("b1").alias("a1"), F.col("a1").alias("b1")).union(rest)
        last = self.store(self.remaining(nodes, texts, shared, roots, compared), "last")
        if last.isEmpty():
            return roots
        links = self.met(texts, shared, self.links(texts, last, "last"))
        return self.connected(roots, links, "last")


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every node with its root, and every row's id and text hash."""
    bounded_batches(docs.sparkSession)
    search = _Search(docs)
    nodes = search.nodes()
    roots = search.classes(nodes)
    named = nodes.select("doc_id", *_TEXT, _name().alias("node"))
    classed = named.join(roots, "node", "left").select(
        "doc_id", *_TEXT, F.coalesce("root", "node").alias("root")
    )
    rows = search.spark.read.parquet(f"{search.folder}/sketches").select("doc_id", *_TEXT)
    return search.store(classed.distinct(), "classes"), rows


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """One row a document: ``doc_id``, ``class_id`` (the least id of its class), ``class_size``."""
    nodes, rows = _classes(docs)
    counts = rows.groupBy(*_TEXT).agg(F.count(F.lit(1)).alias("copies"))
    sized = nodes.join(counts, list(_TEXT))
    names = sized.groupBy("root").agg(
        F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size")
    )
    of_text = nodes.select(*_TEXT, "root").join(names, "root")
    return rows.join(of_text, list(_TEXT)).select("doc_id", "class_id", "class_size")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each class stays, the one with the least id, with all its columns.

    If that row itself is repeated, one of its copies stays.
    """
    nodes, rows = _classes(docs)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *_TEXT)).alias("best")
    chosen = nodes.groupBy("root").agg(best).select("best.doc_id", "best.t1", "best.t2")
    repeated = rows.groupBy("doc_id", *_TEXT).count().where("count > 1")
    marked = chosen.alias("c").join(
        repeated.alias("r"),
        F.expr("c.t1 = r.t1 AND c.t2 = r.t2 AND c.doc_id <=> r.doc_id"),
        "left",
    )
    keys = marked.select(
        F.col("c.doc_id").alias("_id"),
        F.col("c.t1").alias("_t1"),
        F.col("c.t2").alias("_t2"),
        F.col("count").isNotNull().alias("_repeated"),
    )
    t1, t2 = text_hashes()
    # As one struct, so that no column of the documents meets one of the keys.
    hashed = docs.select(
        F.struct("*").alias("row"), "doc_id", t1.alias("h1"), t2.alias("h2")
    )
    same = (
        (F.col("h1") == F.col("_t1"))
        & (F.col("h2") == F.col("_t2"))
        & F.col("doc_id").eqNullSafe(F.col("_id"))
    )
    kept = hashed.join(keys, same)
    once = kept.where("NOT _repeated").select("row.*")
    several = kept.where("_repeated").dropDuplicates(["_id", "_t1", "_t2"]).select("row.*")
    return once.unionByName(several)
