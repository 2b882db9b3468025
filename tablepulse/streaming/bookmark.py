"""Incremental jobs fed by a file stream that reads each file once.

The stream's checkpoint is the bookmark. It moves on only after a batch is
written, so a batch that was lost on the way comes again under the same key,
and the jobs are safe to repeat.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import partial

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tablepulse import schemas
from tablepulse.layout import Site
from tablepulse.operators.rolling import WINDOW_DAYS
from tablepulse.plans.health import ingest_health
from tablepulse.plans.reviews import backfill_reviews, ingest_reviews
from tablepulse.sources.readers import stream_raw, table_exists

Job = Callable[[DataFrame, str], None]


def start_new_files(stream: DataFrame, checkpoint: str, job: Job) -> tuple[StreamingQuery, list]:
    """Begin to give all files not seen before to ``job``; returns the query and its batch keys.

    A batch key joins the stream's own id to the batch number, so that a stream
    started over with a fresh checkpoint does not reuse the keys of the old one.
    Without a new file no batch runs.
    """
    spark = stream.sparkSession
    keys: list[str] = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        stream_id = spark.read.json(f"{checkpoint}/metadata", "id string").first()["id"]
        key = f"{stream_id}-{batch_id}"
        job(batch, key)
        keys.append(key)

    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return query, keys


def run_new_files(stream: DataFrame, checkpoint: str, job: Job) -> int:
    """Give all files not seen before to ``job``, then stop. Returns the number of batches."""
    query, keys = start_new_files(stream, checkpoint, job)
    query.awaitTermination()
    return len(keys)


def backfill_landed_reviews(
    spark: SparkSession,
    site: Site,
    days: int = WINDOW_DAYS,
    plausible: tuple[date, date] | None = None,
    **options,
) -> None:
    """Load all landed files of a site, replace its tables, and take the files as seen.

    The load runs as the stream's batch, so the bookmark moves on only once the tables
    are published. It reads the whole landing folder: a file that lands meanwhile may be
    loaded already, and is merged by the next run, which changes nothing.
    """
    backfill_all_sites(spark, [site], days, plausible, **options)


def backfill_all_sites(
    spark: SparkSession,
    sites: Sequence[Site],
    days: int = WINDOW_DAYS,
    plausible: tuple[date, date] | None = None,
    **options,
) -> None:
    """``backfill_landed_reviews`` for several sites, side by side."""

    def load(site: Site, *_) -> None:
        backfill_reviews(spark, site, days=days, plausible=plausible, **options)

    batches = _side_by_side(spark, sites, load, None, options)
    for site, number in zip(sites, batches, strict=True):
        if not number:
            load(site)


def ingest_new_reviews(
    spark: SparkSession,
    site: Site,
    days: int = WINDOW_DAYS,
    max_files_per_trigger: int | None = None,
    plausible: tuple[date, date] | None = None,
    **options,
) -> int:
    """Ingest the review files that landed since the last run."""
    return ingest_all_sites(spark, [site], days, max_files_per_trigger, plausible, **options)[0]


def ingest_all_sites(
    spark: SparkSession,
    sites: Sequence[Site],
    days: int = WINDOW_DAYS,
    max_files_per_trigger: int | None = None,
    plausible: tuple[date, date] | None = None,
    **options,
) -> list[int]:
    """Ingest the new files of several sites side by side, one stream each.

    The sites share no table folder. If one fails, even before it has begun, the
    others still finish before its error is raised. A site without a landing folder
    has no new file. Returns the number of batches per site.
    """
    def ingest(site: Site, batch: DataFrame, key: str) -> None:
        ingest_reviews(site, batch, key, days, plausible)

    return _side_by_side(spark, sites, ingest, max_files_per_trigger, options)


def _side_by_side(
    spark: SparkSession,
    sites: Sequence[Site],
    job: Callable[[Site, DataFrame, str], None],
    max_files_per_trigger: int | None,
    options: dict,
) -> list[int]:
    """Give the new files of each site to ``job``, one stream a site."""
    started: list[tuple[StreamingQuery, list] | None] = []
    errors: list[Exception] = []
    for site in sites:
        if not table_exists(spark, site.landing):
            started.append(None)
            continue
        try:
            stream = stream_raw(
                spark, site.landing, schemas.RAW_REVIEWS, max_files_per_trigger, **options
            )
            started.append(start_new_files(stream, site.checkpoint, partial(job, site)))
        except Exception as error:
            errors.append(error)
    for begun in started:
        try:
            if begun:
                begun[0].awaitTermination()
        except StreamingQueryException as error:
            errors.append(error)
    if errors:
        raise errors[0]
    return [len(begun[1]) if begun else 0 for begun in started]


def ingest_new_health(
    spark: SparkSession,
    site: Site,
    max_files_per_trigger: int | None = None,
    plausible: tuple[date, date] | None = None,
    **options,
) -> int:
    """Ingest the health-grade files that landed since the last run."""
    if not table_exists(spark, site.landing):
        return 0
    stream = stream_raw(spark, site.landing, schemas.RAW_HEALTH, max_files_per_trigger, **options)
    return run_new_files(
        stream, site.checkpoint, lambda batch, key: ingest_health(site, batch, key, plausible)
    )
