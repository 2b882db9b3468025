"""Sinks.

A table that is partitioned by date gets one shuffle by date before the write.
The ``rebalance`` hint lets adaptive execution cut a large date into several
files and put small ones together, so the number of files follows the bytes
and not tasks times dates, and a heavy date is no single task.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablepulse.schemas import MALFORMED


def _by_date(df: DataFrame, date_col: str, clustered: bool) -> DataFrame:
    return df if clustered else df.hint("rebalance", date_col)


def write_archive(raw: DataFrame, path: str, batch_key: str) -> None:
    """Keep a batch as it came, always with a header. Writing a batch again replaces it.

    The text of malformed lines goes to the rejects.
    """
    raw.drop(MALFORMED).write.mode("overwrite").option("header", True).csv(f"{path}/batch={batch_key}")


def replace_table(df: DataFrame, path: str, date_col: str | None, clustered: bool = False) -> None:
    """Replace a whole table. ``df`` must not read the same path.

    ``clustered`` skips the shuffle for rows that lie together by date already.
    """
    if date_col is None:
        df.write.mode("overwrite").parquet(path)
    else:
        _by_date(df, date_col, clustered).write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).partitionBy(date_col).parquet(path)


def overwrite_partitions(
    df: DataFrame, path: str, *partition_cols: str, clustered: bool = False
) -> None:
    """Replace the partitions that occur in ``df`` and leave all others.

    ``df`` may read the same path: new files are moved into place only when the
    whole job is done. Read the table again afterwards; a frame from before
    still lists the old files.
    """
    _by_date(df, partition_cols[0], clustered).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*partition_cols).parquet(path)


def append_rows(df: DataFrame, path: str, *partition_cols: str) -> None:
    """Add rows. A second run adds them again, so the jobs here do not use it."""
    writer = df.write.mode("append")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of a table. One that does not exist is no error."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def drop_partitions(spark: SparkSession, path: str, date_col: str, dates: Iterable[date]) -> None:
    """Delete date partitions, for dates that a replacement left without rows."""
    for day in dates:
        delete_folder(spark, f"{path}/{date_col}={day.isoformat()}")


def replace_date_partitions(df: DataFrame, path: str, date_col: str, dates: Iterable[date]) -> None:
    """Make ``df`` the whole content of ``dates``, also of those where it has no rows."""
    written = Observation()
    observed = df.observe(written, F.collect_set(date_col).alias("days"))
    overwrite_partitions(observed, path, date_col)
    drop_partitions(df.sparkSession, path, date_col, set(dates) - set(written.get["days"]))
