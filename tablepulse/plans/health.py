"""Health-grade jobs over stored tables.

``input_parquet``  distinct inspections by grade date
``restaurants``    attributes and active span, one row per restaurant and batch
``grade_runs``     the grade from each inspection day to the next one, by its first day

A new file is merged with the inspections already stored, so that a grade is carried
from one file to the next. Only the runs that it changes are recomputed, and only the
dates on which such a run begins are replaced, so a repeated file writes no run. Days are
made from the runs on reading. All tables of a batch are published as one release.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepulse import schemas
from tablepulse.functions import day
from tablepulse.layout import GRADE_RUNS, HEALTH_SITE, INPUT, RESTAURANTS, Site
from tablepulse.operators.grades import days_of_runs, updated_runs
from tablepulse.operators.merge import merge_partitions, union_all
from tablepulse.operators.normalize import normalize_health, rejected, usable
from tablepulse.operators.rolling import attach_restaurants
from tablepulse.operators.rollups import merge_restaurants, restaurants, touched_dates
from tablepulse.plans.report import BatchReport, batch_report
from tablepulse.schemas import with_site
from tablepulse.sources.releases import Release, current_release, read_released
from tablepulse.sources.writers import replace_table, write_archive

ATTRIBUTES = ("restaurant_name", "county", "cuisine")


def ingest_health(
    site: Site, raw: DataFrame, batch_key: str, plausible: tuple[date, date] | None = None
) -> BatchReport:
    """Merge one batch of raw inspections and recompute the days it affects."""
    spark = raw.sparkSession
    raw = raw.persist()
    try:
        batch = normalize_health(raw)
        write_archive(raw, site.history, batch_key)
        good = batch.where(usable("grade_date", plausible))
        days_seen = touched_dates(
            batch.withColumn("usable", usable("grade_date", plausible)), "grade_date", "usable"
        ).collect()
        report = batch_report(batch_key, days_seen)
        if report.rejected:
            bad = rejected(raw, "grade_date", plausible)
            replace_table(bad, f"{site.rejects}/batch={batch_key}", None)
        touched = [row["grade_date"] for row in days_seen if row["n_usable"]]
        if not touched:
            return report

        release = current_release(spark, site)
        stored = release.read(INPUT, schemas.HEALTH, touched)
        merged = merge_partitions(stored, good, "grade_date", touched, match_on="restaurant_id")
        release.replace(merged, INPUT, "grade_date", touched)
        log = restaurants(good, ATTRIBUTES, "grade_date").withColumn("batch", F.lit(batch_key))
        release.replace(log, RESTAURANTS, "batch", [batch_key])
        update_runs(release, good, min(touched))
    finally:
        raw.unpersist()
    release.commit()
    return report


def update_runs(release: Release, batch: DataFrame, start: date) -> None:
    """Replace the dates on which a run begins that the batch adds or changes.

    Of the stored runs those of the batch's restaurants are read that can follow or
    precede its inspections. The driver sees the dates of the changed runs only.
    """
    stored = release.read(GRADE_RUNS, schemas.GRADE_RUNS)
    reaching = F.col("valid_to").isNull() | (F.col("valid_to") >= day(start - timedelta(1)))
    seen = batch.select("restaurant_id").distinct()
    near = stored.where(reaching).join(seen, "restaurant_id", "left_semi")
    changed = updated_runs(near, batch, start).persist()
    try:
        dates = [row[0] for row in changed.select("valid_from").distinct().collect()]
        if not dates:
            return
        names = schemas.GRADE_RUNS.names
        keys = ["restaurant_id", "valid_from"]
        kept = release.read(GRADE_RUNS, schemas.GRADE_RUNS, dates).join(
            changed.select(*keys), keys, "left_anti"
        )
        release.replace(
            union_all(kept.select(names), changed.select(names)), GRADE_RUNS, "valid_from", dates
        )
    finally:
        changed.unpersist()


def read_health_restaurants(spark: SparkSession, root: str) -> DataFrame:
    """Latest attributes, the cuisine among them, and inspection span per restaurant."""
    schema = with_site(schemas.HEALTH_RESTAURANTS)
    log = read_released(spark, root, RESTAURANTS, schema, [HEALTH_SITE])
    return merge_restaurants(log, ATTRIBUTES)


def read_grade_runs(
    spark: SparkSession, root: str, restaurant_ids: Sequence[str] = ()
) -> DataFrame:
    """The stored grade runs of all restaurants, or of those named."""
    schema = with_site(schemas.GRADE_RUNS)
    runs = read_released(spark, root, GRADE_RUNS, schema, [HEALTH_SITE]).drop("site")
    chosen = list(restaurant_ids)
    return runs.where(F.col("restaurant_id").isin(chosen)) if chosen else runs


def read_grade_values(
    spark: SparkSession, root: str, restaurant_ids: Sequence[str] = ()
) -> DataFrame:
    """The grade in force on every day, with name and cuisine."""
    facts = days_of_runs(read_grade_runs(spark, root, restaurant_ids))
    return attach_restaurants(
        facts, read_health_restaurants(spark, root), "restaurant_name", "cuisine"
    ).select("restaurant_id", "grade_date", "restaurant_name", "cuisine", "health_grade")
