"""The registered queries of the operators over the sample tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    decontaminate,
    fingerprints,
    html_text,
    language,
    mixing,
    near_dedup,
    neighbours,
    phrases,
    pii,
    quality,
    substrings,
    tokens,
)

FOLDS = 5


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _remainder() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS


def _held_out() -> Column:
    return F.coalesce(_remainder() == 0, F.lit(False)).alias("held_out")


def op1_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return near_dedup.near_duplicate_classes(_read(spark, folder, "documents"))


def op2_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    pages = _read(spark, folder, "pages").select("page_id", "url", "html")
    return html_text.main_text(pages, html_text.fit_extractor(pages))


def op3_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its size, its source's target and the words taken."""
    mixed = mixing.mix_sources(_read(spark, folder, "documents"))
    return mixed.select(
        "doc_id", F.col("size").cast("long").alias("size"), "source_size", "target", "taken"
    )


def op4_lz_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.compare_with_next(_read(spark, folder, "documents"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Calibrated quality of every document."""
    docs = _read(spark, folder, "documents")
    labels = _read(spark, folder, "labels")
    scored = quality.score_quality(docs, labels, _remainder() != 0, _remainder() == 4)
    return scored.select("doc_id", _held_out(), "score", "predicted")


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that contain benchmark items, and which."""
    docs = _read(spark, folder, "documents")
    return decontaminate.contaminated(docs, _read(spark, folder, "benchmark"))


def op7_token_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """Exact histogram of encoded lengths with its suffix sums."""
    return tokens.length_histogram(tokens.token_lengths(_read(spark, folder, "documents")))


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    return pii.find_pii(_read(spark, folder, "documents"))


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that repeated windows of 35 words cover, removed."""
    kept = substrings.remove_repeats(_read(spark, folder, "documents"))
    digest = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_words", "n_removed", digest)


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document."""
    docs = _read(spark, folder, "documents")
    model = language.fit_language(docs.where(_remainder() != 0))
    predicted = language.predict_language(docs.select("doc_id", "text"), model)
    return predicted.select("doc_id", _held_out(), "lang_pred", "score")


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2,000 collocations of every language."""
    return phrases.collocations(_read(spark, folder, "documents"))


def op12_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 vectors nearest to every twentieth one."""
    vectors = _read(spark, folder, "embeddings")
    return neighbours.nearest(vectors, F.col("vec_id") % 20 == 0)


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of the tokens of two vocabularies in every document."""
    aligned = alignment.align_tokens(_read(spark, folder, "documents"))
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    return aligned.withColumn("groups_sha256", digest).drop("groups")


QUERIES = {
    query.__name__: query
    for query in (
        op1_order_minhash,
        op2_html_text,
        op3_source_mix,
        op4_lz_fingerprint,
        op5_quality,
        op6_decontaminate,
        op7_token_lengths,
        op8_pii,
        op9_substring_dedup,
        op10_language,
        op11_phrases,
        op12_neighbours,
        op13_alignment,
    )
}
