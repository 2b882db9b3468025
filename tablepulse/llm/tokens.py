"""Exact length histogram: one row for each encoded length, with suffix sums.

Documents are encoded in Arrow batches inside tasks and counted by length with
map-side sums, so a hot length costs one row a task. D different lengths need at
least D*D/2 tokens, so the histogram is at most about the square root of the corpus
(14 million rows at 10^14 tokens); the suffix sums run over that table alone.

The vocabulary is a rank file of a public byte-level tokenizer. The driver reads it
(or Spark, if the path has a scheme) and broadcasts its entries, a fixed size.

Long runs of white space, on which the encoder's pattern search would exhaust its stack,
are cut off where the pattern itself cuts, so lengths stay those of the whole text; work
on a very long text is about linear in it.

Null and empty texts have length 0. Repeated rows count once each. Other columns are
not read. An empty table gives an empty histogram.
"""

from __future__ import annotations

import base64
import functools
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrays import bounded_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: the split pattern that belongs to the 50k byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# Fixed value: the white space of that pattern.
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = 5000

_LONG_RUNS = re.compile(rf"[{SPACES}]{{{LONG_RUN},}}")


def text_length(encoder, text: str) -> int:
    """Number of tokens of a text.

    Before a long run of white space the pattern always cuts. It takes the run as one
    piece, but for its last character if text follows, which belongs to what follows.
    """
    total, at = 0, 0
    for run in _LONG_RUNS.finditer(text):
        end = run.end() - (run.end() < len(text))
        total += len(encoder.encode_ordinary(text[at : run.start()]))
        total += len(encoder._encode_single_piece(text[run.start() : end]))
        at = end
    return total + len(encoder.encode_ordinary(text[at:]))


def read_ranks(spark: SparkSession, path: str) -> list[str]:
    """The lines of a rank file."""
    if "://" in path:
        return [row[0] for row in spark.read.text(path).collect()]
    with open(path, encoding="ascii") as lines:
        return lines.read().splitlines()


@functools.lru_cache(maxsize=2)
def _encoder(lines: tuple[str, ...]):
    import tiktoken

    ranks = {
        base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x)
    }
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_lengths(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One ``n_tokens`` a document."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(tuple(read_ranks(spark, vocabulary)))

    def encode(batches):
        encoder = _encoder(shared.value)
        for batch in batches:
            lengths = [
                text_length(encoder, text) if text else 0
                for text in batch.column(0).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64())], ["n_tokens"])

    return docs.select("text").mapInArrow(encode, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """Documents by length; what is longer; and the total if every document is cut there.

    ``truncated_tokens`` is the sum of min(length, n_tokens), ``tokens_up_to`` the sum
    of the lengths that reach at most n_tokens, ``share_up_to`` the share of documents.
    """
    counts = lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))
    order = Window.orderBy("n_tokens")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    longer = order.rowsBetween(1, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tokens = F.col("n_tokens") * F.col("n_docs")
    return (
        counts.withColumn("docs_longer", F.coalesce(F.sum("n_docs").over(longer), F.lit(0)))
        .withColumn("tokens_up_to", F.sum(tokens).over(upto))
        .withColumn("total_tokens", F.sum(tokens).over(everything))
        .withColumn("docs_up_to", F.sum("n_docs").over(upto))
        .withColumn("n_all", F.sum("n_docs").over(everything))
        .select(
            "n_tokens",
            "n_docs",
            "docs_longer",
            "tokens_up_to",
            (F.col("tokens_up_to") + F.col("n_tokens") * F.col("docs_longer")).alias(
                "truncated_tokens"
            ),
            "total_tokens",
            (F.col("docs_up_to") / F.col("n_all")).alias("share_up_to"),
        )
    )


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """One row: the tokens left if every document is cut to ``limit``."""
    return histogram.agg(
        F.coalesce(
            F.sum(F.least(F.col("n_tokens"), F.lit(limit)) * F.col("n_docs")), F.lit(0)
        ).alias("truncated_tokens")
    )


def length_quantile(histogram: DataFrame, share: float) -> DataFrame:
    """One row: the least length that at least this share of documents does not exceed."""
    return histogram.where(F.col("share_up_to") >= share).agg(F.min("n_tokens").alias("n_tokens"))
