"""The registered queries: each operator over the sample tables.

A query that writes uses a new folder below the shared scratch folder and
returns what it reads back.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepulse import schemas
from tablepulse.layout import HEALTH_SITE, INPUT, Site, health_site
from tablepulse.operators import insights
from tablepulse.operators.affected import affected_dates as affected
from tablepulse.operators.calendar import daily_calendar, densify as fill_gaps, join_calendar
from tablepulse.operators.grades import daily_grade, forward_fill_grades as fill_grades, grade_runs as runs_of
from tablepulse.operators.merge import (
    in_dates,
    merge_partitions as merge,
    not_in_dates,
    replace_dates as replace,
    set_union,
    union_all,
)
from tablepulse.operators.normalize import normalize_reviews
from tablepulse.operators.rolling import attach_restaurants, rated_days, rating_timeline
from tablepulse.operators.rollups import (
    active_span as span,
    daily_rating as daily,
    restaurants as latest_restaurants,
    touched_dates as touched,
)
from tablepulse.plans.health import read_grade_values
from tablepulse.plans.reviews import read_final_rating, recompute_reviews
from tablepulse.plans.summaries import (
    read_cross_site_outliers,
    read_cuisine_site_counts,
    read_rating_profile,
)
from tablepulse.session import scratch_dir
from tablepulse.sources import sample_tables as sample
from tablepulse.sources.catalog import publish_warehouse, refresh, register_view
from tablepulse.sources.readers import read_dates, read_raw, read_table, stream_raw, tag_site
from tablepulse.sources.releases import current_release
from tablepulse.sources.writers import (
    append_rows,
    overwrite_partitions,
    replace_date_partitions,
    replace_table,
)
from tablepulse.streaming.bookmark import (
    backfill_all_sites,
    ingest_all_sites,
    ingest_new_health,
    run_new_files,
)

Query = Callable[[SparkSession, str], DataFrame]

GOOGLE = "google_reviews"
IDENTITY = ("restaurant_id", "restaurant_name", "county")
TIMELINE = (*IDENTITY, "review_date", "rating_sum", "rating_count", "final_rating")
ZERO = {"rating_sum": 0, "rating_count": 0}

# Uploads overlap between these hours, so that merging meets known rows.
NOON, EVENING = 12, 18
WEEKEND = (1, 7)


def _named_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return sample.named(sample.reviews(spark, folder), spark, folder)


def _stored_form(df: DataFrame) -> DataFrame:
    return df.select(schemas.REVIEWS.names)


def _weekends(reviews: DataFrame) -> list[date]:
    """The weekend dates that occur; as many as the calendar has at most."""
    dates = touched(reviews).where(F.dayofweek("review_date").isin(*WEEKEND))
    return [row["review_date"] for row in dates.collect()]


def _timeline(spark: SparkSession, folder: str) -> DataFrame:
    """Rolling rating of all sites together; names are joined to the finished series."""
    series = rating_timeline(sample.reviews(spark, folder))
    names = sample.restaurants(spark, folder)
    return attach_restaurants(series, names, "restaurant_name", "county").select(*TIMELINE)


def _all_timelines(spark: SparkSession, folder: str) -> DataFrame:
    """Rolling rating of all sites in one pass."""
    return rating_timeline(sample.all_reviews(spark, folder), keys=("site", "restaurant_id"))


def _rounded(column: str):
    """Six digits, and zero without a sign."""
    rounded = F.round(column, 6)
    return F.when(rounded == 0, F.lit(0.0)).otherwise(rounded)


def _land(raw: DataFrame, schema, path: str) -> None:
    """Upload one more set of files."""
    raw.select(schema.names).write.mode("append").option("header", True).csv(path)


# Sources and sinks


def raw_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    site = Site(scratch_dir(spark), GOOGLE)
    _land(sample.raw_reviews(spark, folder), schemas.RAW_REVIEWS, site.landing)
    return normalize_reviews(read_raw(spark, site.landing, schemas.RAW_REVIEWS))


def raw_history(spark: SparkSession, folder: str) -> DataFrame:
    """The archive of an upload with its columns in another order and one more."""
    site = Site(scratch_dir(spark), GOOGLE)
    raw = sample.raw_reviews(spark, folder)
    raw.select(*reversed(raw.columns)).write.option("header", True).csv(site.landing)
    ingest_all_sites(spark, [site])
    archived = read_raw(spark, site.history, schemas.RAW_REVIEWS)
    hour = F.col("posted_hour").cast("int").alias("posted_hour")
    reviews = archived.withColumn("rating", F.col("rating").cast("int"))
    return reviews.select(*schemas.RAW_REVIEWS.names, hour)


def bookmark_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Two uploads, a run after each and one more without a new file; each row arrives once."""
    site = Site(scratch_dir(spark), GOOGLE)
    raw = sample.raw_reviews(spark, folder)

    def keep(batch: DataFrame, key: str) -> None:
        replace_table(normalize_reviews(batch), f"{site.table('input_parquet')}/batch={key}", None)

    def run() -> int:
        stream = stream_raw(spark, site.landing, schemas.RAW_REVIEWS)
        return run_new_files(stream, site.checkpoint, keep)

    _land(raw.where(F.col("posted_hour") < NOON), schemas.RAW_REVIEWS, site.landing)
    run()
    _land(raw.where(F.col("posted_hour") >= NOON), schemas.RAW_REVIEWS, site.landing)
    run()
    run()
    return read_table(spark, site.table("input_parquet"), schemas.REVIEWS).select(schemas.REVIEWS.names)


def site_tagged_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """One site after the other by the same code, each tagged with its name."""
    return union_all(
        *(tag_site(sample.reviews(spark, folder, site), site) for site in sample.SITES)
    ).select("review_id", "restaurant_id", "rating", "review_date", "site")


def _partitioned_reviews(spark: SparkSession, folder: str) -> str:
    path = Site(scratch_dir(spark), GOOGLE).table("input_parquet")
    replace_table(_stored_form(_named_reviews(spark, folder)), path, "review_date")
    return path


def pruned_dates(spark: SparkSession, folder: str) -> DataFrame:
    path = _partitioned_reviews(spark, folder)
    dates = _weekends(sample.reviews(spark, folder))
    return read_dates(spark, path, schemas.REVIEWS, "review_date", dates)


def excluded_dates(spark: SparkSession, folder: str) -> DataFrame:
    path = _partitioned_reviews(spark, folder)
    dates = _weekends(sample.reviews(spark, folder))
    return not_in_dates(read_table(spark, path, schemas.REVIEWS), "review_date", dates)


def appended_grades(spark: SparkSession, folder: str) -> DataFrame:
    """Append sink: each call adds rows and keeps those before."""
    path = health_site(scratch_dir(spark)).table("grade_values")
    grades = sample.health(spark, folder)
    columns = schemas.GRADE_VALUES.names
    append_rows(grades.where(F.col("posted_hour") < NOON).select(columns), path)
    append_rows(grades.where(F.col("posted_hour") >= NOON).select(columns), path)
    return read_table(spark, path, schemas.GRADE_VALUES)


def cast_project(spark: SparkSession, folder: str) -> DataFrame:
    register_view(sample.named(sample.health(spark, folder), spark, folder), "tablepulse_health")
    return spark.sql(
        "SELECT grade_date, CAST(restaurant_id AS STRING) AS restaurant_id, restaurant_name, "
        "cuisine, health_grade FROM tablepulse_health"
    )


# Rollups


def daily_rating(spark: SparkSession, folder: str) -> DataFrame:
    return daily(_named_reviews(spark, folder))


def active_span(spark: SparkSession, folder: str) -> DataFrame:
    return span(_named_reviews(spark, folder), IDENTITY)


def restaurant_attributes(spark: SparkSession, folder: str) -> DataFrame:
    return latest_restaurants(_named_reviews(spark, folder))


def _stored_and_batch(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = _named_reviews(spark, folder)
    stored = rows.where(F.col("posted_hour") < EVENING)
    batch = rows.where(F.col("posted_hour") >= NOON)
    return _stored_form(stored), _stored_form(batch)


def distinct_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return set_union(*_stored_and_batch(spark, folder))


def touched_dates(spark: SparkSession, folder: str) -> DataFrame:
    return touched(sample.reviews(spark, folder))


def row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return sample.all_reviews(spark, folder).groupBy("site").agg(F.count("*").alias("n_rows"))


def rating_profile(spark: SparkSession, folder: str) -> DataFrame:
    profile = insights.column_profile(sample.reviews(spark, folder), "rating")
    return profile.select(
        F.col("summary").alias("statistic"), F.round(F.col("rating").cast("double"), 6).alias("rating")
    )


# Calendars and series


def date_sequence(spark: SparkSession, folder: str) -> DataFrame:
    return daily_calendar(_named_reviews(spark, folder), IDENTITY, "review_date")


def calendar_join(spark: SparkSession, folder: str) -> DataFrame:
    """Daily totals on the calendar of all sites together."""
    calendar = daily_calendar(sample.all_reviews(spark, folder), ("restaurant_id",), "review_date")
    facts = daily(sample.reviews(spark, folder), ("restaurant_id",))
    return join_calendar(calendar, facts, ("restaurant_id", "review_date"), ZERO)


def grade_calendar_join(spark: SparkSession, folder: str) -> DataFrame:
    grades = daily_grade(sample.health(spark, folder))
    calendar = daily_calendar(grades, ("restaurant_id",), "grade_date")
    joined = join_calendar(calendar, grades, ("restaurant_id", "grade_date"))
    return joined.withColumn("health_grade", F.col("health_grade").cast("double"))


def densify(spark: SparkSession, folder: str) -> DataFrame:
    facts = daily(sample.reviews(spark, folder), ("restaurant_id",))
    return fill_gaps(facts, ("restaurant_id",), "review_date", ZERO)


def rolling_rating(spark: SparkSession, folder: str) -> DataFrame:
    return _timeline(spark, folder)


def shipment_timeline(spark: SparkSession, folder: str) -> DataFrame:
    """The rolling rating over a series of several years."""
    return rating_timeline(sample.shipments(spark, folder))


def ordered_head(spark: SparkSession, folder: str) -> DataFrame:
    return insights.head(_timeline(spark, folder), 20, "restaurant_id", "review_date")


def ordered_tail(spark: SparkSession, folder: str) -> DataFrame:
    return insights.tail(_timeline(spark, folder), 5, "restaurant_id", "review_date")


def forward_fill_grades(spark: SparkSession, folder: str) -> DataFrame:
    grades = fill_grades(sample.health(spark, folder))
    names = sample.restaurants(spark, folder)
    return attach_restaurants(grades, names, "restaurant_name", "cuisine").select(
        "restaurant_id", "grade_date", "restaurant_name", "cuisine", "health_grade"
    )


# Merging and recomputation


def merge_partitions(spark: SparkSession, folder: str) -> DataFrame:
    path = Site(scratch_dir(spark), GOOGLE).table("input_parquet")
    stored, batch = _stored_and_batch(spark, folder)
    replace_table(stored, path, "review_date")
    dates = [row["review_date"] for row in touched(batch).collect()]
    stored = read_table(spark, path, schemas.REVIEWS)
    merged = merge(stored, batch, "review_date", dates, match_on="review_id")
    overwrite_partitions(merged, path, "review_date")
    return read_table(spark, path, schemas.REVIEWS)


def affected_dates(spark: SparkSession, folder: str) -> DataFrame:
    dates = touched(sample.reviews(spark, folder)).where(
        F.dayofweek("review_date").isin(*WEEKEND)
    )
    return affected(dates).select("review_date", "is_touched", "is_output")


def replace_dates(spark: SparkSession, folder: str) -> DataFrame:
    """A series from the morning's reviews, recomputed from all reviews on weekends."""
    path = Site(scratch_dir(spark), GOOGLE).table("final_rating")
    rows = sample.reviews(spark, folder)
    columns = schemas.FINAL_RATING.names
    replace_table(
        rating_timeline(rows.where(F.col("posted_hour") < NOON)).select(columns), path, "review_date"
    )
    dates = _weekends(rows)
    recomputed = in_dates(rating_timeline(rows), "review_date", dates).select(columns)
    replace_date_partitions(recomputed, path, "review_date", dates)
    return read_table(spark, path, schemas.FINAL_RATING)


def replaced_dates_in_memory(spark: SparkSession, folder: str) -> DataFrame:
    """The same replacement as a transform, the dates taken from a frame."""
    rows = sample.reviews(spark, folder)
    dates = (
        touched(rows).where(F.dayofweek("review_date").isin(*WEEKEND)).select("review_date")
    )
    before = rating_timeline(rows.where(F.col("posted_hour") < NOON))
    recomputed = in_dates(rating_timeline(rows), "review_date", dates)
    return replace(before, recomputed, "review_date", dates).select(schemas.FINAL_RATING.names)


def _backfill(spark: SparkSession, folder: str, root: str) -> None:
    sites = [Site(root, name) for name in sample.SITES]
    for site in sites:
        _land(sample.raw_reviews(spark, folder, site.name), schemas.RAW_REVIEWS, site.landing)
    backfill_all_sites(spark, sites)


def backfill_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """A full load of all sites, side by side."""
    root = scratch_dir(spark)
    _backfill(spark, folder, root)
    return read_final_rating(spark, root)


def _ingested(spark: SparkSession, folder: str) -> str:
    """All sites in three uploads each, the earliest days last and some rows twice."""
    root = scratch_dir(spark)
    sites = [Site(root, name) for name in sample.SITES]
    early = F.coalesce(F.col("review_date") < "20240111", F.lit(False))
    hour = F.col("posted_hour")
    for upload in (~early & (hour < EVENING), ~early & (hour >= NOON), early):
        for site in sites:
            raw = sample.raw_reviews(spark, folder, site.name).where(upload)
            _land(raw, schemas.RAW_REVIEWS, site.landing)
        ingest_all_sites(spark, sites)
    return root


def incremental_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Uploads in any order give what a full load gives."""
    return read_final_rating(spark, _ingested(spark, folder))


def malformed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews of the morning cut off behind their date; each line reaches the rejects as it came."""
    site = Site(scratch_dir(spark), GOOGLE)
    raw = sample.raw_reviews(spark, folder)
    whole = raw.select(schemas.RAW_REVIEWS.names)
    _land(whole.where(raw["posted_hour"] >= NOON), schemas.RAW_REVIEWS, site.landing)
    broken = raw.where(F.col("posted_hour") < NOON)
    # One unquoted column named as the header line, so that every file begins with it.
    line = F.concat_ws(",", "review_id", "review_date").alias(",".join(schemas.RAW_REVIEWS.names))
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    plain = {"header": True, "sep": "\x01", "quote": "", "emptyValue": "", **spaces}
    broken.select(line).write.mode("append").options(**plain).csv(site.landing)
    ingest_all_sites(spark, [site])
    rejects = spark.read.parquet(site.rejects)
    return rejects.select("review_id", F.col(schemas.MALFORMED).alias("line"))


def ingest_health(spark: SparkSession, folder: str) -> DataFrame:
    """Two uploads of inspections, the later days first."""
    root = scratch_dir(spark)
    site = health_site(root)
    raw = sample.raw_health(spark, folder)
    early = F.coalesce(F.col("grade_date") < "20240116", F.lit(False))
    for upload in (~early, early):
        _land(raw.where(upload), schemas.RAW_HEALTH, site.landing)
        ingest_new_health(spark, site)
    return read_grade_values(spark, root)


def grade_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The grade from each inspection day to the next one."""
    return runs_of(sample.health(spark, folder))


def uncommitted_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The morning's reviews are published; a job that loads all is lost before its release."""
    root = scratch_dir(spark)
    site = Site(root, GOOGLE)
    raw = sample.raw_reviews(spark, folder, GOOGLE)
    _land(raw.where(F.col("posted_hour") < NOON), schemas.RAW_REVIEWS, site.landing)
    ingest_all_sites(spark, [site])
    lost = current_release(spark, site)
    lost.replace(normalize_reviews(raw), INPUT, "review_date")
    recompute_reviews(lost)
    return read_final_rating(spark, root)


# Insights


def graded_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """The rolling rating of every rated day beside the grade in force, as of that day."""
    rated = _rated(spark, folder).where("final_rating is not null")
    graded = insights.ratings_with_grades(rated, runs_of(sample.health(spark, folder)))
    return graded.select("site", "restaurant_id", "review_date", "final_rating", "health_grade")


def _rated(spark: SparkSession, folder: str) -> DataFrame:
    """The days of all series that have a rolling rating."""
    keys = ("site", "restaurant_id")
    return rated_days(daily(sample.all_reviews(spark, folder), keys), keys=keys, beyond=False)


def rating_hygiene_corr(spark: SparkSession, folder: str) -> DataFrame:
    result = insights.rating_hygiene_correlation(
        _rated(spark, folder), runs_of(sample.health(spark, folder))
    )
    return result.withColumn("r", _rounded("r"))


def summed_hygiene_corr(spark: SparkSession, folder: str) -> DataFrame:
    sums = insights.correlation_sums(_rated(spark, folder), runs_of(sample.health(spark, folder)))
    return insights.correlation_of_sums(sums).withColumn("r", _rounded("r"))


def rating_hygiene_corr_by_restaurant(spark: SparkSession, folder: str) -> DataFrame:
    result = insights.rating_hygiene_correlation(
        _rated(spark, folder), runs_of(sample.health(spark, folder)), per_restaurant=True
    )
    return result.withColumn("r", _rounded("r"))


def quality_timeline(spark: SparkSession, folder: str) -> DataFrame:
    timeline = insights.quality_timeline(
        _all_timelines(spark, folder), fill_grades(sample.health(spark, folder))
    )
    grade = F.col("health_grade").cast("double")
    return timeline.withColumn("health_grade", grade).orderBy("restaurant_id", "day", "site")


def cuisine_site_counts(spark: SparkSession, folder: str) -> DataFrame:
    return insights.cuisine_site_counts(
        sample.all_reviews(spark, folder), sample.restaurants(spark, folder)
    )


def cross_site_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return insights.cross_site_outliers(sample.all_reviews(spark, folder), threshold=0.5)


def _warehouse(spark: SparkSession, folder: str) -> str:
    """All sites and inspections, loaded in a new folder."""
    root = scratch_dir(spark)
    _backfill(spark, folder, root)
    _land(sample.raw_health(spark, folder), schemas.RAW_HEALTH, health_site(root).landing)
    ingest_new_health(spark, health_site(root))
    return root


def stored_cuisine_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Review counts from the stored daily totals."""
    return read_cuisine_site_counts(spark, _warehouse(spark, folder))


def stored_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """Cross-site outliers from the stored daily totals, kept by batches."""
    return read_cross_site_outliers(spark, _ingested(spark, folder), threshold=0.5)


def stored_rating_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics of all ratings from the stored daily histograms, kept by batches."""
    profile = read_rating_profile(spark, _ingested(spark, folder))
    return profile.withColumn("rating", F.round("rating", 6))


def _published(spark: SparkSession, folder: str) -> dict[str, str]:
    """A warehouse of all sites and its SQL names, which each run replaces."""
    names = publish_warehouse(spark, _warehouse(spark, folder), prefix="sample_")
    for name in names.values():
        refresh(spark, name)
    return names


def published_sql(spark: SparkSession, folder: str) -> DataFrame:
    """Ad-hoc SQL over the published tables of all sites."""
    names = _published(spark, folder)
    return spark.sql(
        f"SELECT site, county, CAST(count(*) AS BIGINT) AS n_days, sum(rating_count) AS n_reviews, "
        f"max(final_rating) AS best_rating FROM {names['final_rating']} GROUP BY site, county"
    )


def published_cuisine_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Stored reviews per cuisine and site, in SQL; the cuisine comes from inspections."""
    names = _published(spark, folder)
    return spark.sql(
        f"SELECT c.cuisine, r.site, CAST(sum(r.n) AS BIGINT) AS n_reviews FROM "
        f"(SELECT site, restaurant_id, count(*) AS n FROM {names['reviews']} GROUP BY ALL) r "
        f"LEFT JOIN (SELECT restaurant_id, cuisine FROM {names['restaurants']} "
        f"WHERE site = '{HEALTH_SITE}') c ON r.restaurant_id = c.restaurant_id "
        f"GROUP BY c.cuisine, r.site"
    )


def republished_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """SQL over tables that are published, changed by a batch, and published again."""
    root = scratch_dir(spark)
    site = Site(root, GOOGLE)
    raw = sample.raw_reviews(spark, folder, GOOGLE)
    for upload in (F.col("posted_hour") < EVENING, F.col("posted_hour") >= NOON):
        _land(raw.where(upload), schemas.RAW_REVIEWS, site.landing)
        ingest_all_sites(spark, [site])
        names = publish_warehouse(spark, root, prefix="again_")
    return spark.sql(
        f"SELECT county, CAST(count(*) AS BIGINT) AS n_days, sum(rating_count) AS n_reviews, "
        f"max(final_rating) AS best_rating FROM {names['final_rating']} GROUP BY county"
    )


QUERIES: dict[str, Query] = {
    function.__name__: function
    for function in (
        raw_csv_roundtrip,
        raw_history,
        bookmark_ingest,
        site_tagged_reviews,
        pruned_dates,
        excluded_dates,
        appended_grades,
        cast_project,
        daily_rating,
        active_span,
        restaurant_attributes,
        distinct_reviews,
        touched_dates,
        row_counts,
        rating_profile,
        date_sequence,
        calendar_join,
        grade_calendar_join,
        densify,
        rolling_rating,
        shipment_timeline,
        ordered_head,
        ordered_tail,
        forward_fill_grades,
        merge_partitions,
        affected_dates,
        replace_dates,
        replaced_dates_in_memory,
        backfill_reviews,
        incremental_reviews,
        ingest_health,
        grade_runs,
        uncommitted_batch,
        malformed_lines,
        stored_cuisine_counts,
        stored_outliers,
        stored_rating_profile,
        graded_ratings,
        rating_hygiene_corr,
        summed_hygiene_corr,
        rating_hygiene_corr_by_restaurant,
        quality_timeline,
        cuisine_site_counts,
        cross_site_outliers,
        published_sql,
        published_cuisine_counts,
        republished_ratings,
    )
}
