"""Review jobs over stored tables: full backfill and incremental ingestion.

Both leave the same tables behind, whatever the order of the batches and
however often one is repeated, and publish them as one release: readers see all tables
of a batch or none.

``input_parquet``  distinct reviews by review date
``restaurants``    attributes and active span, one row per restaurant and batch
``rating_sum``     totals of every day with reviews, by review date
``final_rating``   the same with the rolling rating, on these days and the six after
``rating_histogram``  reviews by rating and review date

On every other day of a series nothing was counted and there is no rating. The readers
add these days from the spans, so a restaurant that returns after a pause, or a date
far off, rewrites a week and not the time between.

Where a rule differs from a plain full load: exact copies of a review count
once in both jobs; a series belongs to a restaurant id and shows the latest
name and county; rows without a usable date or id go to ``rejects``; a window
without any rating gives null.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablepulse import schemas
from tablepulse.functions import day
from tablepulse.layout import (
    FINAL_RATING,
    HEALTH_SITE,
    INPUT,
    RATING_HISTOGRAM,
    RATING_SUM,
    RESTAURANTS,
    Site,
)
from tablepulse.operators.affected import affected_dates
from tablepulse.operators.calendar import join_calendar
from tablepulse.operators.merge import in_dates, merge_partitions
from tablepulse.operators.normalize import normalize_reviews, rejected, usable
from tablepulse.operators.rolling import SERIES, WINDOW_DAYS, rated_days
from tablepulse.operators.rollups import (
    daily_rating,
    merge_restaurants,
    restaurants,
    touched_dates,
)
from tablepulse.plans.report import BatchReport, batch_report
from tablepulse.schemas import with_site
from tablepulse.sources.readers import read_raw
from tablepulse.sources.releases import Release, current_release, read_released
from tablepulse.sources.writers import delete_folder, replace_table, write_archive

ATTRIBUTES = ("restaurant_name", "county")
DateRange = tuple[date, date]
BACKFILL = "backfill"


def backfill_reviews(
    spark: SparkSession,
    site: Site,
    raw_path: str | None = None,
    days: int = WINDOW_DAYS,
    plausible: DateRange | None = None,
    **options,
) -> None:
    """Load all raw files of a site and replace its tables. ``options`` reach the file reader.

    See ``streaming.bookmark.backfill_landed_reviews`` for a site that a stream goes on with.
    """
    raw = read_raw(spark, raw_path or site.landing, schemas.RAW_REVIEWS, **options)
    write_archive(raw, site.history, BACKFILL)
    counts = Observation()
    reviews = normalize_reviews(raw).observe(
        counts, F.count_if(~usable("review_date", plausible)).alias("n_rejected")
    )
    good = reviews.where(usable("review_date", plausible)).distinct()
    release = current_release(spark, site)
    release.replace(good, INPUT, "review_date")
    delete_folder(spark, site.rejects)
    if counts.get["n_rejected"]:
        bad = rejected(raw, "review_date", plausible)
        replace_table(bad, f"{site.rejects}/batch={BACKFILL}", None)
    recompute_reviews(release, days)
    release.commit()


def recompute_reviews(release: Release, days: int = WINDOW_DAYS) -> None:
    """Rebuild everything that derives from the stored reviews of a release.

    The reviews are grouped once, for ``rating_sum``; the ratings come from these totals.
    """
    stored = release.read(INPUT, schemas.REVIEWS)
    log = restaurants(stored, ATTRIBUTES).withColumn("batch", F.lit(BACKFILL))
    release.replace(log, RESTAURANTS, "batch")
    release.replace(_totals(stored), RATING_SUM, "review_date")
    release.replace(_histogram(stored), RATING_HISTOGRAM, "review_date", clustered_by=None)
    totals = release.read(RATING_SUM, schemas.RATING_SUM)
    rated = rated_days(totals, days).select(schemas.FINAL_RATING.names)
    release.replace(rated, FINAL_RATING, "review_date")


def _totals(reviews: DataFrame) -> DataFrame:
    """Daily totals; ``review_count`` also counts reviews without a rating."""
    every = F.count(F.lit(1)).alias("review_count")
    daily = daily_rating(reviews, SERIES, every).fillna(0, ["rating_sum"])
    return daily.select(schemas.RATING_SUM.names)


def _histogram(reviews: DataFrame) -> DataFrame:
    counts = reviews.groupBy("review_date", "rating").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(schemas.RATING_HISTOGRAM.names)


def ingest_reviews(
    site: Site,
    raw: DataFrame,
    batch_key: str,
    days: int = WINDOW_DAYS,
    plausible: DateRange | None = None,
) -> BatchReport:
    """Merge one batch of raw rows and recompute the dates it affects.

    Safe to repeat: partitions are replaced by content that does not depend on
    whether the batch was applied before. A batch that breaks off leaves the tables as
    they were. The driver sees dates only, to pick the partitions to read.
    """
    spark = raw.sparkSession
    raw = raw.persist()
    try:
        batch = normalize_reviews(raw)
        write_archive(raw, site.history, batch_key)
        good = batch.where(usable("review_date", plausible))
        days_seen = touched_dates(
            batch.withColumn("usable", usable("review_date", plausible)), "review_date", "usable"
        ).collect()
        report = batch_report(batch_key, days_seen)
        if report.rejected:
            bad = rejected(raw, "review_date", plausible)
            replace_table(bad, f"{site.rejects}/batch={batch_key}", None)
        touched = [row["review_date"] for row in days_seen if row["n_usable"]]
        if not touched:
            return report

        release = current_release(spark, site)
        stored = release.read(INPUT, schemas.REVIEWS, touched)
        merged = merge_partitions(stored, good, "review_date", touched, match_on="review_id")
        release.replace(merged, INPUT, "review_date", touched)
        log = restaurants(good, ATTRIBUTES).withColumn("batch", F.lit(batch_key))
        release.replace(log, RESTAURANTS, "batch", [batch_key])
    finally:
        raw.unpersist()

    update_ratings(release, touched, days)
    release.commit()
    return report


def update_ratings(release: Release, touched: list[date], days: int = WINDOW_DAYS) -> None:
    """Recompute ``rating_sum`` and ``final_rating`` on the dates that a merged batch affects.

    These are the touched dates and the ``days - 1`` after each, whatever the batch does
    to the span of a restaurant: days without information are not stored.
    """
    plan = affected_dates(
        release.spark.createDataFrame([(when,) for when in touched], "review_date date"), days
    ).collect()
    needed = [row["review_date"] for row in plan]
    outputs = [row["review_date"] for row in plan if row["is_output"]]

    reviews = release.read(INPUT, schemas.REVIEWS, touched)
    release.replace(_totals(reviews), RATING_SUM, "review_date", touched)
    release.replace(
        _histogram(reviews), RATING_HISTOGRAM, "review_date", touched, clustered_by=None
    )

    totals = release.read(RATING_SUM, schemas.RATING_SUM, needed)
    rated = in_dates(rated_days(totals, days), "review_date", outputs)
    release.replace(
        rated.select(schemas.FINAL_RATING.names), FINAL_RATING, "review_date", outputs
    )


def read_restaurants(spark: SparkSession, root: str, sites: Sequence[str] = ()) -> DataFrame:
    """Latest attributes and active span per site and restaurant."""
    log = read_released(spark, root, RESTAURANTS, with_site(schemas.REVIEW_RESTAURANTS), sites)
    reviewed = log.where(F.col("site") != HEALTH_SITE)
    return merge_restaurants(reviewed, ATTRIBUTES, ("site", "restaurant_id"))


def _every_day(
    spark: SparkSession,
    root: str,
    table: str,
    schema: StructType,
    sites: Sequence[str],
    between: DateRange | None,
    only: Sequence[str],
) -> DataFrame:
    """A stored table with names and with the days that it leaves out.

    The spans of the restaurants give the days; ``between`` cuts them to a closed range
    and names the stored partitions to read. ``only`` names restaurants: stored rows are
    sorted by them within a date, so that other row groups are skipped.
    """
    facts = read_released(spark, root, table, with_site(schema), sites, between)
    named = read_restaurants(spark, root, sites)
    if only:
        facts, named = (df.where(F.col("restaurant_id").isin(list(only))) for df in (facts, named))
    first_day, last_day = F.col("first_date"), F.col("last_date")
    if between:
        first_day, last_day = F.greatest(first_day, day(between[0])), F.least(last_day, day(between[1]))
    calendar = (
        named.where(first_day <= last_day)
        .select(
            "site",
            "restaurant_id",
            *ATTRIBUTES,
            F.explode(F.sequence(first_day, last_day)).alias("review_date"),
        )
    )
    keys = ("site", "restaurant_id", "review_date")
    return join_calendar(calendar, facts, keys, {"rating_sum": 0, "rating_count": 0})


def read_rating_sum(
    spark: SparkSession,
    root: str,
    sites: Sequence[str] = (),
    between: DateRange | None = None,
    restaurant_ids: Sequence[str] = (),
) -> DataFrame:
    """The dense daily totals of the given sites with name and county."""
    dense = _every_day(
        spark, root, RATING_SUM, schemas.RATING_SUM, sites, between, restaurant_ids
    )
    return dense.select(
        "site", "restaurant_id", "restaurant_name", "county", "rating_sum", "rating_count", "review_date"
    )


def read_final_rating(
    spark: SparkSession,
    root: str,
    sites: Sequence[str] = (),
    between: DateRange | None = None,
    restaurant_ids: Sequence[str] = (),
) -> DataFrame:
    """The dense daily series of the given sites with the rolling rating, name and county."""
    dense = _every_day(
        spark, root, FINAL_RATING, schemas.FINAL_RATING, sites, between, restaurant_ids
    )
    return dense.select(
        "site",
        "restaurant_name",
        "county",
        "rating_sum",
        "rating_count",
        "review_date",
        "final_rating",
        "restaurant_id",
    )
