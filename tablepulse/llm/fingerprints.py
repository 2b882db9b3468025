"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into dictionary phrases (LZ78 over code points): each phrase is the
longest known one and the next character. The set of phrase hashes is sketched by its
``KEPT`` smallest values, written as eight hexadecimal digits each, ascending. Likeness
of two fingerprints is the share of common values among the ``KEPT`` smallest of both,
an estimate of the Jaccard likeness of the phrase sets, which is high if one text helps
to compress the other.

``compare_with_next`` needs each text beside the next one by descending id. Ids are cut
into ranges by their quantiles (ids that are not numbers by those of the ``DRAWN`` ids a
range with the least hashes), as many as there are shuffle partitions. Each range becomes
one partition, sorted, and gets a copy of the first row of the range after it (the last range that of the
first). So texts are shuffled once, and a task holds two texts at a time however many
rows a range has. The driver gets one id a range, or ``DRAWN`` where ids are not numbers.

Null texts count as empty. A text without phrases has the empty fingerprint; two empty
ones are alike (1.0), an empty and another are not (0.0). Null ids come last; rows with
the same id follow each other by text hash. Repeated rows are rows of their own. A
table of one row is its own next. Other columns are not read; an empty table gives no
row. Very long texts are parsed in pieces of a fixed size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .arrays import CHARS, bounded_batches, codes_of, mix

KEPT = 128
DRAWN = 64  # ids a range, to cut ids that are not numbers
_MASK = (1 << 64) - 1
_FACTOR = 0x9E3779B97F4A7C15
_POINT = 21  # bits of a code point


class Phrases:
    """The dictionary of a parse, which can go on and be taken back to a mark."""

    def __init__(self) -> None:
        self.known: dict[int, int] = {}
        self.hashes: list[int] = [1]
        self.node = 0
        self._added: list[int] | None = None
        self._mark = 0

    def parse(self, text: str) -> None:
        known, hashes, node, added = self.known, self.hashes, self.node, self._added
        for begin in range(0, len(text), CHARS):
            for code in codes_of(text[begin : begin + CHARS]).tolist():
                key = node << _POINT | code
                following = known.get(key)
                if following is None:
                    known[key] = len(hashes)
                    hashes.append((hashes[node] * _FACTOR + code + 1) & _MASK)
                    if added is not None:
                        added.append(key)
                    node = 0
                else:
                    node = following
        self.node = node

    def mark(self) -> None:
        """Remember this place; only what is parsed after it can be taken back."""
        self._added, self._mark = [], self.node

    def back(self) -> None:
        added = self._added or []
        for key in added:
            del self.known[key]
        if added:
            del self.hashes[-len(added) :]
        self.node, self._added = self._mark, []

    def values(self) -> np.ndarray:
        """The smallest hash values, ascending."""
        spread = mix(np.array(self.hashes[1:], dtype=np.uint64)) >> np.uint64(32)
        if len(spread) > 4 * KEPT:
            spread = np.partition(spread, 3 * KEPT)[: 3 * KEPT]
        return np.unique(spread)[:KEPT]


def fingerprint(values: np.ndarray) -> str:
    return values.astype(">u4").tobytes().hex()


def values_of(written: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(written), dtype=">u4").astype(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    both = np.union1d(a, b)[:KEPT]
    if not len(both):
        return 1.0
    common = np.intersect1d(a, b, assume_unique=True)
    return int((common <= both[-1]).sum()) / len(both)


class _Pending:
    """A document that waits for the next one."""

    def __init__(self, doc_id, text: str, tail: int):
        self.doc_id, self.text, self.tail = doc_id, text, tail
        self.phrases = Phrases()
        self.phrases.parse(text[: len(text) - tail])
        self.phrases.mark()
        self.phrases.parse(text[len(text) - tail :])
        self.values = self.phrases.values()

    def beside(self, following: "_Pending") -> tuple:
        head = following.text[: self.tail]
        edited = self.text[: len(self.text) - self.tail] + head
        self.phrases.back()
        self.phrases.parse(head)
        values = self.phrases.values()
        return (
            self.doc_id,
            len(self.text),
            hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            fingerprint(self.values),
            fingerprint(values),
            likeness(self.values, values),
            likeness(self.values, following.values),
        )


RESULT = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _bounds(docs: DataFrame, number: int) -> list:
    """Ascending ids that cut all ids into at most ``number`` ranges of about equal size."""
    if isinstance(docs.schema["doc_id"].dataType, NumericType):
        shares = [float(x) for x in np.linspace(0, 1, number + 1)[1:-1]] or [0.5]
        found = docs.agg(F.percentile_approx("doc_id", shares, 10 * max(number, 1000)).alias("x"))
        return sorted({float(x) for x in found.head()["x"] or []})
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct()
    drawn = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(DRAWN * number).collect()
    return sorted(row[0] for row in drawn)[DRAWN::DRAWN]


def _ranges(docs: DataFrame, number: int):
    """A function that gives the range of an id, 0 for the greatest ids, the last for nulls."""
    found = _bounds(docs, number)
    dtype = np.float64 if isinstance(docs.schema["doc_id"].dataType, NumericType) else object
    bounds = np.array(found, dtype=dtype)

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        at = np.full(len(ids), len(bounds) + 1, np.int32)
        values = ids[known].to_numpy(dtype=dtype)
        at[known] = len(bounds) - np.searchsorted(bounds, values, side="left")
        return pd.Series(at)

    return place


def compare_with_next(docs: DataFrame, share: int = 3) -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likeness.

    In the edited text the last ``1 / share`` of the characters is replaced by as many
    from the start of the next document.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    number = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = _ranges(docs, number)
    rows = docs.select(
        "doc_id",
        F.xxhash64("text").alias("_hash"),
        F.coalesce("text", F.lit("")).alias("text"),
        place("doc_id").alias("_range"),
    )
    first = F.max(F.struct("doc_id", "_hash")).alias("first")
    heads = rows.drop("text").groupBy("_range").agg(first).orderBy("_range").collect()
    # At most one row a range: the first document, sent to the range before it too.
    before = [
        (heads[at - 1]["_range"], head["first"]["doc_id"], head["first"]["_hash"])
        for at, head in enumerate(heads)
    ]
    copies = spark.createDataFrame(before, f"_to int, _id {kind}, _head long")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_head"))
    extra = rows.join(F.broadcast(copies), same).select(
        "doc_id", "_hash", "text", F.col("_to").alias("_range"), F.lit(1).alias("_extra")
    )
    placed = rows.withColumn("_extra", F.lit(0)).unionByName(extra)
    # Each range, and the null ids, are a partition of their own.
    ordered = placed.repartitionById(number + 1, "_range").sortWithinPartitions(
        "_range", "_extra", F.col("doc_id").desc_nulls_last(), F.col("_hash").desc()
    )

    def compare(batches):
        waiting, where, done = None, None, False
        for batch in batches:
            out = []
            ids, texts, ranges, extras = (batch.column(at).to_pylist() for at in range(4))
            for doc_id, text, here, more in zip(ids, texts, ranges, extras, strict=True):
                if here != where:
                    waiting, where, done = None, here, False
                if done:
                    continue  # a repeated row was copied more than once
                current = _Pending(doc_id, text, len(text) // share)
                if waiting is not None:
                    out.append(waiting.beside(current))
                waiting, done = current, bool(more)
            columns = list(zip(*out, strict=True)) or [()] * 7
            kinds = [batch.schema.field(0).type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            arrays = [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)]
            names = ["doc_id"] + [field.split()[0] for field in RESULT.split(", ")]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return ordered.select("doc_id", "text", "_range", "_extra").mapInArrow(
        compare, f"doc_id {kind}, {RESULT}"
    )
