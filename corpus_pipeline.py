"""From raw documents to a training mix: five stages, each one operator of ``tablepulse.llm``.

Every stage takes the session, the documents that the stage before kept and the folder
of the tables, and returns a frame that is written as Parquet and read again. All but
the last return the columns of ``documents``.

1. language ID: documents in no language learned, or in another than their label, go.
2. near-dedup: one document of each near-duplicate class stays.
3. decontamination: documents that contain a benchmark item go.
4. PII: personal data is replaced by its kind; ``n_chars`` follows the text.
5. mixing: each document is repeated so that sources come near their targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepulse.llm import decontaminate, language, mixing, near_dedup, pii
from tablepulse.session import scratch_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.fit_language(docs)
    return language.keep_known_language(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, benchmark)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    redacted = pii.redact_documents(docs)
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit_copies(mixing.mix_sources(docs))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
]

# Language, alignment and redaction are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each read from what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_dir(spark)
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
