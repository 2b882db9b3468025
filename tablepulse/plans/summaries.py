"""Insights from the stored daily totals: they grow with days and restaurants, not with reviews.

The totals are replaced date by date with each batch, so what is read here is always that
of the current release, and a range of dates reads its own partitions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepulse import schemas
from tablepulse.layout import RATING_HISTOGRAM, RATING_SUM
from tablepulse.operators.insights import counts_by_cuisine, histogram_profile, outliers_of_totals
from tablepulse.plans.health import read_health_restaurants
from tablepulse.sources.releases import read_released

DateRange = tuple[date, date]


def site_totals(
    spark: SparkSession, root: str, sites: Sequence[str] = (), between: DateRange | None = None
) -> DataFrame:
    """Sums and counts per restaurant and site, of all dates or of a closed range."""
    schema = schemas.with_site(schemas.RATING_SUM)
    daily = read_released(spark, root, RATING_SUM, schema, sites, between)
    return daily.groupBy("restaurant_id", "site").agg(
        *(F.sum(name).alias(name) for name in ("rating_sum", "rating_count", "review_count"))
    )


def read_cuisine_site_counts(
    spark: SparkSession, root: str, between: DateRange | None = None
) -> DataFrame:
    """Number of reviews per cuisine and site; the cuisine is that of the inspections."""
    totals = site_totals(spark, root, between=between)
    counts = totals.select("restaurant_id", "site", F.col("review_count").alias("n_reviews"))
    return counts_by_cuisine(counts, read_health_restaurants(spark, root))


def read_cross_site_outliers(
    spark: SparkSession, root: str, threshold: float = 1.0, between: DateRange | None = None
) -> DataFrame:
    """Sites whose mean rating of a restaurant is far from its mean over all sites."""
    return outliers_of_totals(site_totals(spark, root, between=between), threshold)


def read_rating_profile(
    spark: SparkSession, root: str, sites: Sequence[str] = (), between: DateRange | None = None
) -> DataFrame:
    """Statistics of the ratings of the given sites and dates, without reading a review."""
    schema = schemas.with_site(schemas.RATING_HISTOGRAM)
    histogram = read_released(spark, root, RATING_HISTOGRAM, schema, sites, between)
    return histogram_profile(histogram, "rating")
