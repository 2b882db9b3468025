"""Scans. Every one has an explicit schema."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablepulse.operators.merge import in_dates
from tablepulse.schemas import MALFORMED

# Files are known by their paths alone; none is too old to be new.
ANY_AGE = "36500d"


def _raw_schema(spark: SparkSession, path: str, schema: StructType, **options) -> StructType:
    """All columns of the files as text, in the order of their header line.

    Fails, with its name, on a column of ``schema`` that the header lacks.
    """
    reader = spark.read.options(header=True, recursiveFileLookup=True, **options)
    if not reader.schema(schema).csv(path).inputFiles():
        return schema
    found = spark.read.options(header=True, recursiveFileLookup=True, **options).csv(path).schema
    known = {name.lower() for name in found.names}
    missing = [name for name in schema.names if name.lower() not in known]
    if missing:
        raise ValueError(f"files in {path} have no column {', '.join(missing)}")
    return found


def read_raw(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """Delimited files with a header line, by the names in it.

    The columns of ``schema`` come first, then all others, whatever their order in the
    files. A file whose header differs from that of the others fails the read, so no
    value gets into a wrong column; files of another layout belong into another folder.
    A line with too few or too many fields, or with a quote that is not closed, keeps its
    text in the column ``_malformed``, by which the jobs reject it.

    ``options`` reach Spark's reader, for instance ``multiLine`` for texts with
    line breaks (such a file is read by a single task).
    """
    found = _raw_schema(spark, path, schema, **options)
    reader = spark.read.schema(_with_malformed(found)).options(
        header=True,
        enforceSchema=False,
        recursiveFileLookup=True,
        columnNameOfCorruptRecord=MALFORMED,
        **options,
    )
    return _known_first(reader.csv(path), schema)


def _with_malformed(schema: StructType) -> StructType:
    known = {name.lower() for name in schema.names}
    return schema if MALFORMED in known else StructType([*schema.fields, StructField(MALFORMED, StringType())])


def _known_first(raw: DataFrame, schema: StructType) -> DataFrame:
    known = {name.lower() for name in schema.names}
    others = [name for name in raw.columns if name.lower() not in known]
    return raw.select(*(F.col(f"`{name}`").alias(name) for name in [*schema.names, *others]))


def stream_raw(
    spark: SparkSession,
    path: str,
    schema: StructType,
    max_files_per_trigger: int | None = None,
    **options,
) -> DataFrame:
    """The same files as a stream, each of them once.

    A file is known by its path, so every upload needs a new name, and a file with an
    old modification time is as new as any.
    """
    found = _raw_schema(spark, path, schema, **options)
    reader = spark.readStream.schema(_with_malformed(found)).options(
        header=True,
        enforceSchema=False,
        recursiveFileLookup=True,
        maxFileAge=ANY_AGE,
        columnNameOfCorruptRecord=MALFORMED,
        **options,
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _known_first(reader.csv(path), schema)


def table_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored table; one that was never written is empty."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_dates(
    spark: SparkSession, path: str, schema: StructType, date_col: str, dates: Iterable[date]
) -> DataFrame:
    """The date partitions of a stored table that are listed in ``dates``."""
    return in_dates(read_table(spark, path, schema), date_col, dates)


def tag_site(df: DataFrame, site: str) -> DataFrame:
    return df.withColumn("site", F.lit(site))
