"""Maintenance of stored tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablepulse import schemas
from tablepulse.layout import HEALTH_SITE, RESTAURANTS, Site
from tablepulse.operators.rollups import merge_restaurants
from tablepulse.sources.releases import (
    current_release,
    list_file,
    names_in,
    release_numbers,
    released_sites,
    used_folders,
)
from tablepulse.sources.writers import delete_folder

TABLES = ("input_parquet", "restaurants", "rating_sum", "final_rating", "grade_runs", "rating_histogram")


def compact_restaurants(
    spark: SparkSession,
    site: Site,
    schema: StructType = schemas.REVIEW_RESTAURANTS,
    attributes: Sequence[str] = ("restaurant_name", "county"),
) -> None:
    """Replace the rows that each batch left in ``restaurants`` by one row per restaurant.

    Run it between batches, when none has to be repeated.
    """
    release = current_release(spark, site)
    merged = merge_restaurants(release.read(RESTAURANTS, schema), attributes)
    key = f"compacted-{uuid.uuid4().hex}"
    release.replace(merged.withColumn("batch", F.lit(key)), RESTAURANTS, "batch")
    release.commit()


def clean_releases(spark: SparkSession, site: Site, keep: int = 2) -> int:
    """Delete all but the last ``keep`` releases and every folder that these do not use.

    Run it between batches: the folders of a job that is still writing would go too, as
    those of lost jobs do. Readers of a kept release are not disturbed. Returns the number
    of folders deleted.
    """
    numbers = release_numbers(spark, site)
    kept, old = numbers[-keep:], numbers[:-keep]
    used = used_folders(spark, site, kept)
    versions = {folder.rsplit("/", 1)[0] for folder in used}
    unused: list[str] = []
    for table in TABLES:
        for name in names_in(spark, site.table(table)):
            folder = f"{site.table(table)}/{name}"
            if not name.startswith("version="):
                continue
            if folder not in versions:
                unused.append(folder)
                continue
            parts = (f"{folder}/{part}" for part in names_in(spark, folder) if "=" in part)
            unused += [part for part in parts if part not in used]
    for path in [*(list_file(site, number) for number in old), *unused]:
        delete_folder(spark, path)
    return len(unused)


def upkeep(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Compact ``restaurants`` of every site and delete what its last releases do not use."""
    for site in released_sites(spark, root):
        if site.name == HEALTH_SITE:
            attributes = ("restaurant_name", "county", "cuisine")
            compact_restaurants(spark, site, schemas.HEALTH_RESTAURANTS, attributes)
        else:
            compact_restaurants(spark, site)
        clean_releases(spark, site, keep)
