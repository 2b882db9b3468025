"""Cross-tokenizer alignment by whitespace-token anchors.

Each text is encoded in full by a byte-level BPE (A, on a space and the text) and by a
piece BPE with byte fallback (B, which adds that space itself). Token ends are summed
up as byte offsets. An offset where tokens of both end is a shared end; a shared end
after which both go on with a space-marked token is an anchor. Anchors cut a document
into windows of token ids, and windows recur as words do: the alignment of a window,
its groups and links, is worked out once and kept by the two tuples of ids.

1. ``encode`` works on runs of a few MB. It stores each different window of a run once,
   beside the places where it stands, so that no text is encoded twice and the later
   passes align a window once for all its places;
2. ``count_links`` counts the linked id pairs of the corpus, summed in tasks first;
3. ``align`` gives each document its groups and the counts of its links.

Every pass is a scan with nothing but its own rows. Different pairs are at most the
product of the two vocabularies, whatever the corpus. They reach the tasks of the third
pass as broadcasts of at most ``PAIRS`` pairs, cut by B id; where that takes more than
one, each is a scan of its own and the documents' sums are added up.

Null and empty texts, and texts whose joined token bytes of A or B are not the space
and the text, have no tokens: zeros and empty groups. Very long texts are encoded in
parts, cut where neither encoder can join what lies on both sides: before a single
space between a visible ASCII character and a letter. Repeated rows are rows of their
own. Other columns are not read. An empty table gives no row.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablepulse.session import scratch_dir

from .arrays import bounded_batches, mix, runs

BYTE_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
PART = 1 << 19
RUN = 1 << 20
PAIRS = 1 << 22
IDS = np.dtype("<u2")

SPACE_MARK = "▁"
# Fixed value: the split pattern that belongs to byte-level vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_CUT = re.compile(r"(?<=[!-~]) (?=[A-Za-z])")
LONG_RUN = 2048


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Visible Latin-1 characters stand for themselves, the other bytes in order for the
    characters from U+0100 on.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = sorted(set(range(256)) - set(own))
    return {chr(byte): byte for byte in own} | {
        chr(0x100 + place): byte for place, byte in enumerate(others)
    }


def read_file(spark: SparkSession, path: str) -> bytes:
    """A vocabulary file: by Spark if the path has a scheme, else by the driver."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    with open(path, "rb") as file:
        return file.read()


def has_long_run(text: str) -> bool:
    """True where white space, or text without it, goes on for twice ``LONG_RUN`` characters.

    Such a run fills one of the text's slices; half of that may count as well.
    """
    for at in range(0, len(text) - LONG_RUN + 1, LONG_RUN):
        piece = text[at : at + LONG_RUN]
        if len(piece.split(None, 1)) < 2:
            return True
    return False


class Vocabulary(NamedTuple):
    """What alignment needs of a vocabulary: bytes a token, and whether it begins with a space."""

    sizes: np.ndarray
    spaced: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        sizes = np.array([len(token) for token in tokens], np.int64)
        return cls(sizes, np.array([token.startswith(b" ") for token in tokens]))


class Spelling:
    """The bytes of all tokens of a vocabulary in one array."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.sizes = np.array([len(token) for token in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def spell(self, ids: list[np.ndarray], texts: list[bytes]) -> list[bool]:
        """Whether the tokens of each row, put together, are its text."""
        every = np.concatenate(ids)
        sizes = self.sizes[every]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        lengths = upto[np.cumsum([len(row) for row in ids])]
        text = b"".join(texts)
        if len(text) == upto[-1] and (lengths == np.cumsum([len(x) for x in texts])).all():
            place = np.repeat(self.starts[every] - upto[:-1], sizes) + np.arange(upto[-1])
            if (self.bytes[place] == np.frombuffer(text, np.uint8)).all():
                return [True] * len(texts)
        return [
            b"".join(map(self.tokens.__getitem__, row.tolist())) == text
            for row, text in zip(ids, texts, strict=True)
        ]


class Encoders:
    """Both encoders and the bytes of their tokens."""

    def __init__(self, byte_model: bytes, piece_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_model.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        letters = byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        special = set(self.a.get_added_tokens_decoder())
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, at in vocabulary.items():
            known = all(letter in letters for letter in token)
            self.a_bytes[at] = bytes(map(letters.get, token)) if known else token.encode()
        pieces = [self.b.id_to_piece(at) for at in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(piece[3:5], 16)])
            if self.b.is_byte(at)
            else piece.replace(SPACE_MARK, " ").encode()
            for at, piece in enumerate(pieces)
        ]
        self.vocabularies = Vocabulary.of(self.a_bytes), Vocabulary.of(self.b_bytes)
        self.flat = Spelling(self.a_bytes), Spelling(self.b_bytes)
        ranks = {
            token: at for at, token in enumerate(self.a_bytes) if token and at not in special
        }
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        # A piece that goes on after a space could span a cut.
        self.cuttable = not any(SPACE_MARK in piece.lstrip(SPACE_MARK) for piece in pieces)
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << (8 * IDS.itemsize):
            raise ValueError("a vocabulary has more ids than two bytes tell apart")

    def parts(self, text: str) -> Iterator[str]:
        """The text cut before spaces into parts of about ``PART``; these spaces are left out."""
        at = 0
        while self.cuttable and len(text) - at > PART:
            cut = _CUT.search(text, at + PART)
            if cut is None:
                break
            yield text[at : cut.start()]
            at = cut.end()
        yield text[at:]

    def _ids_of_a(self, parts: list[str]) -> list[np.ndarray]:
        """Ids of A: by its merges as ranks, and by the slower encoder where a run is very long."""
        found = []
        for part in parts:
            if has_long_run(part):
                ids = self.a.encode(f" {part}", add_special_tokens=False).ids
            else:
                ids = self.fast.encode_to_numpy(f" {part}", disallowed_special=())
            found.append(np.asarray(ids, IDS))
        return found

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The ids of A and B for each text; none where the bytes do not agree."""
        cut = [list(self.parts(text)) if text else [] for text in texts]
        flat = [part for parts in cut for part in parts]
        found = self._ids_of_a(flat), [np.array(ids, IDS) for ids in self.b.encode(flat, num_threads=1)]
        bounds = np.cumsum([0, *map(len, cut)]).tolist()
        none = [np.empty(0, IDS)]
        a, b = (
            [np.concatenate(side[x:y] or none) for x, y in zip(bounds, bounds[1:])] for side in found
        )
        whole = [f" {text}".encode() if text else b"" for text in texts]
        same = [self.flat[at].spell(ids, whole) for at, ids in enumerate((a, b))]
        return [
            (x, y) if good and fine else (none[0], none[0])
            for x, y, good, fine in zip(a, b, *same, strict=True)
        ]


@functools.lru_cache(maxsize=1)
def _encoders(byte_model: bytes, piece_model: bytes) -> Encoders:
    return Encoders(byte_model, piece_model)


class Windows(NamedTuple):
    """The windows of some documents: each different one once, and where they stand."""

    order: np.ndarray  # the window at each place of the documents
    per_document: np.ndarray
    a: np.ndarray  # ids of the different windows, one after the other
    a_sizes: np.ndarray
    b: np.ndarray
    b_sizes: np.ndarray

    def times(self) -> np.ndarray:
        return np.bincount(self.order, minlength=len(self.a_sizes))


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the pieces that begin at ``starts``."""
    return np.repeat(starts - _starts(sizes), sizes) + np.arange(sizes.sum())


def _tuple_hashes(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of the ids of each window, which all have some."""
    offsets = _places(np.zeros(len(sizes), np.int64), sizes)
    return np.add.reduceat(mix((ids.astype(np.int64) << 32) + offsets), _starts(sizes))


def _distinct(ids: tuple[np.ndarray, ...], sizes: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The first window of each different pair of tuples, and each window's place among them.

    Hashes bring equal windows together, a comparison of their ids decides.
    """
    hashes = mix(_tuple_hashes(ids[0], sizes[0])) + _tuple_hashes(ids[1], sizes[1])
    _, first, order = np.unique(hashes, return_index=True, return_inverse=True)
    unlike = np.zeros(len(order), bool)
    for x, n in zip(ids, sizes, strict=True):
        same_size = n == n[first[order]]
        begin = _starts(n)
        shift = np.where(same_size, begin[first[order]] - begin, 0)
        other = x[np.arange(len(x)) + np.repeat(shift, n)] != x
        unlike |= ~same_size
        if other.any():
            unlike[np.repeat(np.arange(len(n)), n)[other]] = True
    others = np.flatnonzero(unlike)  # of another one's hash: windows of their own
    order[others] = len(first) + np.arange(len(others))
    return np.concatenate([first, others]), order


def find_windows(
    a: list[np.ndarray], b: list[np.ndarray], of_a: Vocabulary, of_b: Vocabulary
) -> Windows:
    """Cut documents at their anchors."""
    x, y = np.concatenate(a), np.concatenate(b)
    last_a = np.cumsum([len(ids) for ids in a])
    if not len(x):
        none = np.empty(0, np.int64)
        return Windows(none, np.zeros(len(a), np.int64), x, none, y, none)
    ends_a, ends_b = np.cumsum(of_a.sizes[x]), np.cumsum(of_b.sizes[y])
    place = np.searchsorted(ends_b, ends_a)
    shared = np.flatnonzero(ends_b[place] == ends_a)
    after_a, after_b = shared + 1, place[shared] + 1
    # Behind the last token stands none.
    anchor = np.append(of_a.spaced[x], True)[after_a] & np.append(of_b.spaced[y], True)[after_b]
    anchor |= np.isin(after_a, last_a)
    cuts_a, cuts_b = after_a[anchor], after_b[anchor]
    sizes = np.diff(cuts_a, prepend=0), np.diff(cuts_b, prepend=0)
    chosen, order = _distinct((x, y), sizes)
    kept = [
        (ids[_places(_starts(n)[chosen], n[chosen])], n[chosen])
        for ids, n in zip((x, y), sizes, strict=True)
    ]
    upto = np.searchsorted(cuts_a, last_a, "right")
    return Windows(order, np.diff(upto, prepend=0), *kept[0], *kept[1])


class Alignment(NamedTuple):
    """Groups and links of windows that stand one after the other."""

    a_groups: np.ndarray  # the group of each token of A
    b_groups: np.ndarray
    n_groups: np.ndarray  # of each window
    n_links: np.ndarray
    links: np.ndarray  # a << 16 | b, by window


def align_windows(windows: Windows, of_a: Vocabulary, of_b: Vocabulary) -> Alignment:
    """Each window once: groups between shared ends, and all pairs whose bytes overlap."""
    x, y = windows.a.astype(np.int64), windows.b.astype(np.int64)
    sizes_a, sizes_b = of_a.sizes[x], of_b.sizes[y]
    ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    begins_a, begins_b = ends_a - sizes_a, ends_b - sizes_b
    shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
    a_groups, b_groups = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
    first = np.searchsorted(ends_b, begins_a, "right")
    each = np.searchsorted(begins_b, ends_a, "left") - first
    links = np.repeat(x, each) << 16 | y[_places(first, each)]
    last_a = np.cumsum(windows.a_sizes)
    n_groups = np.diff(a_groups[last_a - 1] + 1, prepend=0)
    n_links = np.diff(np.cumsum(each)[last_a - 1], prepend=0)
    return Alignment(a_groups, b_groups, n_groups, n_links, links)


def written(windows: Windows, alignment: Alignment) -> list[bytes]:
    """The groups of each window as text, each with a semicolon behind it."""
    n_a, n_b = len(windows.a), len(windows.b)
    in_a, in_b = alignment.a_groups, alignment.b_groups
    # A group's tokens of A come first, then those of B.
    at_a = np.arange(n_a) + np.searchsorted(in_b, in_a, "left")
    at_b = np.arange(n_b) + np.searchsorted(in_a, in_b, "right")
    ids, marks = np.empty(n_a + n_b, np.int64), np.full(n_a + n_b, ord(","), np.uint8)
    ids[at_a], ids[at_b] = windows.a, windows.b
    for at, groups, mark in ((at_a, in_a, "|"), (at_b, in_b, ";")):
        marks[at[np.append(groups[1:] != groups[:-1], True)]] = ord(mark)
    digits = 1 + sum((ids >= 10**power).astype(np.int64) for power in range(1, 5))
    ends = np.cumsum(digits + 1)
    text = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    text[ends - 1] = marks
    for power in range(5):
        long = digits > power
        text[ends[long] - 2 - power] = ord("0") + ids[long] // 10**power % 10
    last = at_b[np.cumsum(windows.b_sizes) - 1]
    whole, bounds = text.tobytes(), [0, *ends[last].tolist()]
    return [whole[begin:end] for begin, end in zip(bounds, bounds[1:])]


_PACKED = ("order", "per_document", "a", "a_sizes", "b", "b_sizes")
_KINDS = dict.fromkeys(("order", "per_document", "a_sizes", "b_sizes"), np.dtype("<i4")) | {
    "a": IDS,
    "b": IDS,
}


def encode(docs: DataFrame, byte_vocabulary: str, piece_vocabulary: str) -> tuple[DataFrame, Encoders]:
    """The encoded documents in runs, one row each; and the encoders.

    A run holds ``rows`` and ``doc_ids`` of its documents, their token numbers ``n_a``
    and ``n_b``, and their windows, each different one once.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    models = read_file(spark, byte_vocabulary), read_file(spark, piece_vocabulary)
    shared = spark.sparkContext.broadcast(models)

    def encode_texts(batches):
        encoders = _encoders(*shared.value)
        for batch in batches:
            texts = [text or "" for text in batch.column(2).to_pylist()]
            for begin, end in runs([len(text) for text in texts], RUN):
                found = encoders.encode(texts[begin:end])
                a, b = ([ids[side] for ids in found] for side in (0, 1))
                windows = find_windows(a, b, *encoders.vocabularies)
                part = batch.slice(begin, end - begin)
                bounds = pa.array([0, end - begin], pa.int32())
                lists = [
                    pa.ListArray.from_arrays(bounds, values)
                    for values in (
                        part.column(0),
                        part.column(1),
                        *(pa.array([len(ids) for ids in side], pa.int64()) for side in (a, b)),
                    )
                ]
                packed = [
                    pa.array([getattr(windows, name).astype(_KINDS[name]).tobytes()], pa.binary())
                    for name in _PACKED
                ]
                yield pa.RecordBatch.from_arrays(
                    [*lists, *packed], ["rows", "doc_ids", "n_a", "n_b", *_PACKED]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = f"rows array<long>, doc_ids array<{kind}>, n_a array<long>, n_b array<long>"
    fields += "".join(f", {name} binary" for name in _PACKED)
    # The row numbers are stored, so they stay the same in every later scan.
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    path = f"{scratch_dir(spark)}/tokens"
    rows.mapInArrow(encode_texts, fields).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path), _encoders(*models)


def _unpacked(row: dict) -> Windows:
    return Windows(*(np.frombuffer(row[name], _KINDS[name]) for name in _PACKED))


def count_links(encoded: DataFrame, encoders: Encoders) -> DataFrame:
    """Each linked id pair of the corpus: ``a``, ``b``, ``n`` and whether it is ``best`` for its B id."""
    shared = encoded.sparkSession.sparkContext.broadcast(encoders.vocabularies)

    def count(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                windows = _unpacked(batch.slice(at, 1).to_pylist()[0])
                found = align_windows(windows, *shared.value)
                order = np.argsort(found.links, kind="stable")
                links = found.links[order]
                times = np.repeat(windows.times(), found.n_links)[order]
                first = np.flatnonzero(np.diff(links, prepend=-1))
                total = np.add.reduceat(times, first) if len(first) else times
                pairs = links[first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs >> 16), pa.array(pairs & 0xFFFF), pa.array(total)], ["a", "b", "n"]
                )

    each = encoded.select(*_PACKED).mapInArrow(count, "a long, b long, n long")
    counted = each.groupBy("a", "b").agg(F.sum("n").alias("n"))
    highest = F.max("n").over(Window.partitionBy("b"))
    path = f"{scratch_dir(encoded.sparkSession)}/pairs"
    counted.withColumn("best", F.col("n") == highest).write.parquet(path)
    return encoded.sparkSession.read.parquet(path)


class Counts(NamedTuple):
    """Some of the corpus-wide counts, by ascending pair."""

    pairs: np.ndarray
    n: np.ndarray
    best: np.ndarray

    def of(self, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each link is best, and its count; 0 for pairs that are not here."""
        at = np.searchsorted(self.pairs, links)
        at[at == len(self.pairs)] = -1
        here = self.pairs[at] == links if len(self.pairs) else np.zeros(len(links), bool)
        best, n = np.zeros(len(links), np.int64), np.zeros(len(links), np.int64)
        best[here], n[here] = self.best[at[here]], self.n[at[here]]
        return best, n


def _slices(counts: DataFrame, most: int) -> list[tuple[int, int]]:
    """Ranges of B ids with at most ``most`` pairs each, single ids aside."""
    sizes = counts.groupBy("b").count().orderBy("b").collect()  # one row a vocabulary entry
    found, begin, total = [], 0, 0
    for b, size in sizes:
        if total and total + size > most:
            found.append((begin, b))
            begin, total = b, 0
        total += size
    return [*found, (begin, 1 << (8 * IDS.itemsize))]


def align(encoded: DataFrame, counts: DataFrame, encoders: Encoders, most: int = PAIRS) -> DataFrame:
    """Groups and links of each document with the corpus-wide counts of its links."""
    spark = encoded.sparkSession
    kind = encoded.schema["doc_ids"].dataType.elementType.simpleString()
    schema = (
        f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, "
        "n_best long, count_sum long, groups string"
    )
    names = [field.split()[0] for field in schema.split(", ")]

    def scan(begin: int, end: int) -> DataFrame:
        rows = counts.where(F.col("b").between(begin, end - 1))
        table = rows.select((F.col("a") * (1 << 16) + F.col("b")).alias("pair"), "n", "best")
        table = table.orderBy("pair").toArrow()
        known = Counts(
            table["pair"].to_numpy(), table["n"].to_numpy(), table["best"].to_numpy(zero_copy_only=False)
        )
        shared = spark.sparkContext.broadcast((encoders.vocabularies, known))

        def resolve(batches):
            vocabularies, found_counts = shared.value
            for batch in batches:
                for at in range(batch.num_rows):
                    row = batch.slice(at, 1)
                    windows = _unpacked(row.select(_PACKED).to_pylist()[0])
                    found = align_windows(windows, *vocabularies)
                    of_links = [
                        np.concatenate([[0], np.cumsum(values)]) for values in found_counts.of(found.links)
                    ]
                    bounds = np.concatenate([[0], np.cumsum(found.n_links)])
                    of_windows = [found.n_groups, found.n_links, *(np.diff(x[bounds]) for x in of_links)]
                    last = np.concatenate([[0], np.cumsum(windows.per_document, dtype=np.int64)])
                    sums = []
                    for values in of_windows:
                        upto = np.concatenate([[0], np.cumsum(values[windows.order])])
                        sums.append(pa.array(np.diff(upto[last])))
                    texts, order = written(windows, found), windows.order.tolist()
                    groups = [
                        b"".join([texts[at] for at in order[begin:end]])[:-1]
                        for begin, end in zip(last.tolist(), last[1:].tolist())
                    ]
                    lists = [row[name].flatten() for name in ("rows", "doc_ids", "n_a", "n_b")]
                    text = pa.array(groups, pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([*lists, *sums, text], names)

        return encoded.mapInArrow(resolve, schema)

    slices = _slices(counts, most)
    if len(slices) == 1:
        return scan(*slices[0]).drop("row")
    folder = scratch_dir(spark)
    for at, bounds in enumerate(slices):
        scan(*bounds).select("row", "n_best", "count_sum").write.parquet(f"{folder}/slice={at}")
    sums = spark.read.parquet(folder).groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
    )
    return scan(*slices[0]).drop("n_best", "count_sum").join(sums, "row").select(names[1:])


def align_tokens(
    docs: DataFrame,
    byte_vocabulary: str = BYTE_VOCABULARY,
    piece_vocabulary: str = PIECE_VOCABULARY,
) -> DataFrame:
    """``doc_id``, token, group and link numbers, link counts, and ``groups`` of each document.

    ``groups`` reads ``a1,a2|b1;a3|b2,b3``: the ids of A and of B in each group, in order.
    """
    encoded, encoders = encode(docs, byte_vocabulary, piece_vocabulary)
    return align(encoded, count_links(encoded, encoders), encoders)
