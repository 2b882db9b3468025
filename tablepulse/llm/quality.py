"""Quality of a text: random Fourier features, ridge regression, isotonic calibration.

Statistics of a whole text are standardised and mapped to cosines of random
projections, which approximates a Gaussian kernel. Every partition sums its normal
equations, rows of these sums are added by row number, and the driver solves one
system of ``FEATURES`` unknowns. Ridge scores of rows kept from the fit, counted in
``BINS`` bins, are made monotone (pool adjacent violators) and give the final score.
The driver sees sums and counts of fixed size, whatever the corpus.

Statistics are written once to the shared scratch folder, a few numbers a document,
for the fit, the calibration and the scoring.

Null texts count as empty, and empty texts are scored like others. Labels other than 0
and 1 or null, and rows with a null id, are not learned from. Repeated rows weigh as
often as they occur. If labels are missing or all alike, every score is the
share of label 1, or 0.5 without any. Other columns are not read.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tablepulse.session import scratch_dir

from .arrays import bounded_batches, codes_of, pieces

STATISTICS = (
    "characters", "words", "word_length", "upper", "digits", "symbols", "marks",
    "exclamations", "lines", "different_words", "repeated_lines", "shouted", "odd_ends",
    "other_letters", "sentence",
)
FEATURES = 256
BINS = 1000
SEED = 5

LOWER, UPPER, OTHER, DIGIT, SPACE, LINE, STOP, SHOUT, MARK, SYMBOL, REST = range(11)


@functools.cache
def _classes() -> np.ndarray:
    table = np.full(0x110000, REST, np.uint8)
    for code in range(0x3000):
        letter = chr(code)
        if letter.isalpha():
            table[code] = UPPER if letter.isupper() else LOWER if code < 128 else OTHER
    for kind, letters in (
        (DIGIT, "0123456789"),
        (SPACE, " \t\r\v\f"),
        (LINE, "\n"),
        (STOP, ".?"),
        (SHOUT, "!"),
        (MARK, ",;:'\"-()"),
        (SYMBOL, "#$%&*+/<=>@[\\]^_`{|}~"),
    ):
        for letter in letters:
            table[ord(letter)] = kind
    return table


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text, in the order of ``STATISTICS``."""
    text = text or ""
    counts = np.zeros(11, np.int64)
    for piece in pieces(text):
        counts += np.bincount(_classes()[codes_of(piece)], minlength=11)
    size = max(int(counts.sum()), 1)
    words = text.split()
    n_words = max(len(words), 1)
    letters = max(int(counts[LOWER] + counts[UPPER] + counts[OTHER]), 1)
    lines = [line for line in text.split("\n") if line]
    shouted = sum(word.isupper() for word in words)
    ends = sum(not word[-1].isalnum() and word[-1] not in ".,;:?)\"'" for word in words)
    return [
        np.log1p(counts.sum()),
        np.log1p(len(words)),
        (size - counts[SPACE] - counts[LINE]) / n_words,
        counts[UPPER] / letters,
        counts[DIGIT] / size,
        counts[SYMBOL] / size,
        counts[MARK] / size,
        counts[SHOUT] / size,
        len(lines) / n_words,
        np.log1p(len(set(words))) / np.log1p(n_words),
        1 - len(set(lines)) / max(len(lines), 1),
        shouted / n_words,
        ends / n_words,
        counts[OTHER] / letters,
        np.log1p(n_words / (1 + counts[STOP])),
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``stats``."""
    bounded_batches(docs.sparkSession)

    def measure(batches):
        for batch in batches:
            stats = [statistics(text) for text in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(stats, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "stats"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(measure, f"doc_id {kind}, stats array<double>")


@dataclass(frozen=True)
class QualityModel:
    """Standardisation, projection, ridge solution, and the calibration curve."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    shifts: np.ndarray
    solution: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        scaled = np.clip((stats - self.mean) / self.spread, -6, 6)
        waves = np.cos(scaled @ self.weights + self.shifts) * np.sqrt(2 / len(self.shifts))
        return np.column_stack([waves, np.ones(len(stats))])

    def ridge_scores(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(self.features(stats) @ self.solution, 0, 1)

    def scores(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.ridge_scores(stats), self.knots, self.values), 0, 1)


def _projection(width: float) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    weights = random.normal(size=(len(STATISTICS), FEATURES)) / width
    return weights, random.uniform(0, 2 * np.pi, FEATURES)


def _table(column) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64).reshape(-1, len(STATISTICS))


def _normal_equations(rows: DataFrame, model: QualityModel) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all rows: added in each task, then by row number of the matrix."""
    size = FEATURES + 1
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def add(batches):
        total = np.zeros((size, size + 1))
        for batch in batches:
            features = shared.value.features(_table(batch.column(0)))
            wanted = np.array(batch.column(1).to_pylist(), dtype=np.float64)
            total += features.T @ np.column_stack([features, wanted])
        lines = [line.tobytes() for line in total] if total.any() else []
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(lines)), pa.int32()), pa.array(lines, pa.binary())], ["row", "line"]
        )

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        line = np.sum([np.frombuffer(x) for x in frame["line"]], axis=0)
        return pd.DataFrame({"row": frame["row"][:1], "line": [line.tobytes()]})

    kind = "row int, line binary"
    parts = rows.select("stats", "label").mapInArrow(add, kind)
    lines = parts.groupBy("row").applyInPandas(merge, kind).collect()  # FEATURES + 1 rows
    total = np.zeros((size, size + 1))
    for line in lines:
        total[line["row"]] = np.frombuffer(line["line"])
    return total[:, :-1], total[:, -1]


def pool_violators(means: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``means`` by weighted squares."""
    blocks: list[list[float]] = []
    for mean, weight in zip(means, weights, strict=True):
        blocks.append([mean, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            mean2, weight2, count2 = blocks.pop()
            mean1, weight1, count1 = blocks[-1]
            both = weight1 + weight2
            blocks[-1] = [(mean1 * weight1 + mean2 * weight2) / both, both, count1 + count2]
    return np.concatenate([np.full(int(count), mean) for mean, _, count in blocks])


def _ridge(stats: DataFrame, model: QualityModel, extra: list[str], scores: str) -> DataFrame:
    """``score`` by one of the model's methods, beside the extra columns."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def apply(batches):
        for batch in batches:
            values = getattr(shared.value, scores)(_table(batch.column(0)))
            columns = [*batch.columns[1:], pa.array(values, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*extra, "score"])

    read = stats.select("stats", *extra)
    schema = StructType([*read.schema.fields[1:], StructField("score", DoubleType())])
    return read.mapInArrow(apply, schema)


def fit_quality(labelled: DataFrame, width: float = 4.0, ridge: float = 1e-4) -> QualityModel:
    """Fit on rows with ``stats``, ``label`` (0 or 1) and ``calibrate``.

    Rows marked ``calibrate`` set the calibration curve, the others the ridge scores.
    """
    each = [F.col("stats")[at] for at in range(len(STATISTICS))]
    sums = labelled.agg(
        F.count(F.lit(1)),
        F.avg("label"),
        F.coalesce(F.sum(F.col("calibrate").cast("int")), F.lit(0)),
        *(F.avg(x) for x in each),
        *(F.stddev_pop(x) for x in each),
    ).head()
    count, share, later = sums[0], sums[1], sums[2]
    n = len(STATISTICS)
    mean = np.array([0.0 if x is None else x for x in sums[3 : 3 + n]])
    spread = np.array([x or 1.0 for x in sums[3 + n :]])
    weights, shifts = _projection(width)
    flat = np.array([0.5 if share is None else share] * 2)
    model = QualityModel(
        mean, spread, weights, shifts, np.zeros(FEATURES + 1), np.array([0.0, 1.0]), flat
    )
    if not count or share in (0, 1):
        return model
    split = 0 < later < count
    fitted = labelled.where(~F.col("calibrate")) if split else labelled
    left, right = _normal_equations(fitted, model)
    left += ridge * np.trace(left) / len(left) * np.eye(len(left))
    model = QualityModel(
        mean, spread, weights, shifts, np.linalg.solve(left, right), model.knots, flat
    )
    held = labelled.where("calibrate") if split else labelled
    scored = _ridge(held, model, ["label"], "ridge_scores")
    bins = (
        scored.groupBy(F.floor(F.col("score") * BINS).alias("bin"))
        .agg(F.avg("score").alias("knot"), F.avg("label").alias("share"), F.count("*").alias("n"))
        .orderBy("bin")
        .collect()  # at most BINS + 1 rows
    )
    counts = np.array([row["n"] for row in bins], dtype=np.float64)
    level = pool_violators(np.array([row["share"] for row in bins]), counts)
    knots = np.array([row["knot"] for row in bins])
    return QualityModel(mean, spread, weights, shifts, model.solution, knots, level)


def score_quality(
    docs: DataFrame, labels: DataFrame, learn, calibrate, threshold: float = 0.3
) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` of every document.

    ``learn`` and ``calibrate`` are conditions on ``doc_id``: which labels may be used,
    and which of these are kept from the fit for the calibration.
    """
    spark = docs.sparkSession
    path = scratch_dir(spark)
    document_statistics(docs).write.parquet(path)
    stats = spark.read.parquet(path)
    usable = labels.where(F.col("quality").isin(0, 1)).where(learn)
    usable = usable.select("doc_id", F.col("quality").cast("double").alias("label"))
    labelled = stats.join(usable, "doc_id").select(
        "stats", "label", F.coalesce(calibrate, F.lit(False)).alias("calibrate")
    )
    scored = _ridge(stats, fit_quality(labelled), ["doc_id"], "scores")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
