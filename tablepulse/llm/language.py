"""Language of a text by string-kernel classification.

A text is the set of its character n-grams of length 1 to 3 (letters folded, all else
one space), each n-gram in one of ``BUCKETS`` buckets. The blended-spectrum presence
kernel of two texts is the number of shared buckets over the root of the product of
their numbers. Landmark texts span a Nystrom feature space, one kernel ridge
regression a language (one versus rest) is solved there, and texts are scored in
batches: presence matrix times landmark matrix times coefficients.

The model is fitted on a bounded sample: of every language that occurs at most
``per_language`` different texts, those with the smallest hash, and fewer where that
would be more than ``sample`` texts of all languages (one of each is kept); the driver
gets them as bit sets of ``BUCKETS`` bits. Everything else runs over all rows in one
pass without a shuffle. A model is a few megabytes whatever the corpus.

``keep_known_language`` rejects a document without a letter; one in no language learned:
the landmarks know less than ``FAMILIAR`` of its n-grams, beyond what they would by chance
(not asked where landmarks hold over nine tenths of all buckets, which tells nothing); and
one whose own label is contradicted: another language claims it, with a score of at least
``CLAIMED`` and by ``CONTRADICTION`` more than that of its label.

Null texts and texts without a letter are ``und`` with score 0; no language is learned
from them. Without any labelled text all are ``und``. Ties go to the first language by
code point. Repeated rows get the same answer and one copy of a text is learned from.
Columns named ``lang_pred`` or ``score`` are replaced by the results, others kept. Very long texts are read in pieces of a fixed size.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .arrays import bounded_batches, codes_of, pieces, without

UNKNOWN = "und"
BUCKETS = 1 << 14
LONGEST = 3
ROWS = 256
SLICES = 64
FAMILIAR = 0.5
CROWDED = 0.9
CLAIMED = 0.5
CONTRADICTION = 0.25


@functools.cache
def _fold() -> np.ndarray:
    """Lower-case letter of each code point; a space for what is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        letter = chr(code)
        if letter.isalpha():
            low = letter.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


@functools.cache
def _seen() -> np.ndarray:
    return np.zeros(BUCKETS, bool)


def presence(text: str | None) -> np.ndarray:
    """The buckets of a text, ascending; none if it has no letter."""
    seen, letters = _seen(), False
    seen[:] = False
    for piece in pieces(text or ""):
        codes = _fold()[codes_of(piece)]
        space = codes == 32
        codes = codes[~(space & np.append(False, space[:-1]))] if len(codes) else codes
        letters = letters or not space.all()
        total = np.zeros(len(codes), np.uint32)
        for length in range(1, LONGEST + 1):
            if len(codes) < length:
                break
            end = len(codes) - length + 1
            total = total[:end] * np.uint32(0x01000193) + codes[length - 1 :] + np.uint32(length)
            spread = total * np.uint32(0x9E3779B1)
            seen[(spread ^ (spread >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(18)] = True
    return np.flatnonzero(seen) if letters else np.empty(0, np.int64)


@dataclass(frozen=True)
class LanguageModel:
    """Languages, the buckets that a landmark has, landmarks by bucket, coefficients."""

    languages: tuple[str, ...]
    place: np.ndarray
    landmarks: np.ndarray
    coefficients: np.ndarray

    def scores(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row a text, one column a language."""
        table = np.zeros((len(sets), len(self.landmarks)), np.float32)
        for row, buckets in enumerate(sets):
            at = self.place[buckets]
            table[row, at[at >= 0]] = 1 / np.sqrt(max(len(buckets), 1))
        return (table @ self.landmarks) @ self.coefficients[:-1] + self.coefficients[-1]


def _sample(labelled: DataFrame, per_language: int, sample: int) -> DataFrame:
    """Bit sets of the sampled texts with their language."""
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "doc_id", "lang", "text", F.xxhash64("text").alias("_hash")
    )
    languages = known.select("lang").distinct().count()
    each = max(1, min(per_language, sample // max(languages, 1)))
    different = known.groupBy("lang", "_hash").agg(F.min("doc_id").alias("doc_id"))
    # A language may hold most rows: each slice of it offers its first ones.
    slices = Window.partitionBy("lang", F.pmod("_hash", F.lit(SLICES))).orderBy("_hash")
    whole = Window.partitionBy("lang").orderBy("_hash")
    offered = different.withColumn("_rank", F.row_number().over(slices)).where(F.col("_rank") <= each)
    keys = (
        offered.withColumn("_rank", F.row_number().over(whole))
        .where(F.col("_rank") <= each)
        .select("doc_id", "lang", "_hash", "_rank")
    )
    # At most the larger of `sample` and the number of languages.
    chosen = known.join(F.broadcast(keys), ["doc_id", "lang", "_hash"])

    def pack(batches):
        for batch in batches:
            bits = []
            for text in batch.column(2).to_pylist():
                flags = np.zeros(BUCKETS, bool)
                flags[presence(text)] = True
                bits.append(np.packbits(flags).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(bits, pa.binary())],
                ["lang", "rank", "bits"],
            )

    picked = chosen.select("lang", "_rank", "text")
    return picked.mapInArrow(pack, "lang string, rank int, bits binary")


def fit_language(
    labelled: DataFrame,
    per_language: int = 400,
    sample: int = 50_000,
    landmarks: int = 128,
    ridge: float = 1e-3,
) -> LanguageModel | None:
    """Fit on rows with text, lang and doc_id; None if nothing can be learned."""
    bounded_batches(labelled.sparkSession)
    rows = {(r.lang, r.rank): r.bits for r in _sample(labelled, per_language, sample).collect()}
    rows = [(lang, rank, bits) for (lang, rank), bits in sorted(rows.items())]
    sets = [np.unpackbits(np.frombuffer(bits, np.uint8)).astype(np.float32) for *_, bits in rows]
    use = [at for at, flags in enumerate(sets) if flags.any()]
    if not use:
        return None
    rows = [rows[at] for at in use]
    table = np.array([sets[at] / np.sqrt(sets[at].sum()) for at in use])
    names = tuple(sorted({lang for lang, *_ in rows}))
    each = max(1, landmarks // len(names))
    order = {name: [at for at, row in enumerate(rows) if row[0] == name][:each] for name in names}
    chosen = table[[at for name in names for at in order[name]]]
    kernel = (table @ chosen.T).astype(np.float64)
    values, vectors = np.linalg.eigh((chosen @ chosen.T).astype(np.float64))
    good = values > values.max() * 1e-6
    root = vectors[:, good] / np.sqrt(values[good])
    features = np.column_stack([kernel @ root, np.ones(len(table))])
    wanted = np.array([[1.0 if lang == name else -1.0 for name in names] for lang, *_ in rows])
    # Each language weighs the same, whatever its share of the sample.
    weight = np.array([1 / sum(wanted[:, names.index(lang)] > 0) for lang, *_ in rows])
    left = (features * weight[:, None]).T @ features
    left += ridge * np.trace(left) / len(left) * np.eye(len(left))
    solved = np.linalg.solve(left, (features * weight[:, None]).T @ wanted)
    used = np.flatnonzero(chosen.any(axis=0))
    place = np.full(BUCKETS, -1, np.int32)
    place[used] = np.arange(len(used))
    # The last row is the bias.
    coefficients = np.vstack([root @ solved[:-1], solved[-1:]]).astype(np.float32)
    return LanguageModel(names, place, chosen[:, used].T.copy(), coefficients)


def _answers(model: LanguageModel | None, texts: list[str | None]):
    languages, scores = [], []
    for begin in range(0, len(texts), ROWS):
        sets = [presence(text) for text in texts[begin : begin + ROWS]]
        if model is None:
            languages += [UNKNOWN] * len(sets)
            scores += [0.0] * len(sets)
            continue
        values = model.scores(sets)
        best = values.argmax(axis=1)
        top = np.clip((values[np.arange(len(sets)), best] + 1) / 2, 0, 1)
        languages += [
            model.languages[at] if len(buckets) else UNKNOWN
            for at, buckets in zip(best, sets, strict=True)
        ]
        scores += [float(v) if len(b) else 0.0 for v, b in zip(top, sets, strict=True)]
    return languages, scores


def _recognised(model: LanguageModel | None, texts: list, labels: list) -> list[bool]:
    """Whether each text is in a language learned and none contradicts its label."""
    if model is None:
        return [False] * len(texts)
    place = {name: at for at, name in enumerate(model.languages)}
    chance = float((model.place >= 0).mean())
    least = chance + FAMILIAR * (1 - chance) if chance <= CROWDED else 0.0
    kept = []
    for begin in range(0, len(texts), ROWS):
        sets = [presence(text) for text in texts[begin : begin + ROWS]]
        values = (model.scores(sets) + 1) / 2
        for scores, buckets, label in zip(values, sets, labels[begin : begin + ROWS], strict=True):
            if not len(buckets) or (model.place[buckets] >= 0).mean() < least:
                kept.append(False)
                continue
            best = float(scores.max())
            own = float(scores[place[label]]) if label in place else best
            kept.append(best < CLAIMED or best - own < CONTRADICTION)
    return kept


def keep_known_language(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """The documents in a language learned whose label is not contradicted, as they are."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at, label = docs.columns.index("text"), docs.columns.index("lang")

    def keep(batches):
        for batch in batches:
            texts, labels = batch.column(at).to_pylist(), batch.column(label).to_pylist()
            yield batch.filter(pa.array(_recognised(shared.value, texts, labels), pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def predict_language(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``score`` (0 to 1)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    kept = without(docs.columns, ("lang_pred", "score"))
    read = docs.select(*kept)
    at = kept.index("text")

    def predict(batches):
        for batch in batches:
            languages, scores = _answers(shared.value, batch.column(at).to_pylist())
            columns = [*batch.columns, pa.array(languages, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "lang_pred", "score"])

    answers = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    schema = StructType([*read.schema.fields, *answers])
    return read.mapInArrow(predict, schema)
