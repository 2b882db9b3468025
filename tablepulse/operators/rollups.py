"""Daily totals, active spans and restaurant attributes.

All groupings aggregate before they shuffle, so a restaurant, day or site that
holds a large share of the rows arrives as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IDENTITY = ("restaurant_id", "restaurant_name", "county")


def daily_rating(
    reviews: DataFrame, keys: Sequence[str] = IDENTITY, *further: Column
) -> DataFrame:
    """Sum and count of the ratings per restaurant and day. Null ratings do not count.

    ``keys=("restaurant_id",)`` gives the narrow form that the timeline uses:
    only numbers are aggregated, so Spark hashes instead of sorting, and no
    text travels through the later shuffles. ``further`` are other aggregates of a day.
    """
    return reviews.groupBy(*keys, "review_date").agg(
        F.sum("rating").alias("rating_sum"), F.count("rating").alias("rating_count"), *further
    )


def active_span(
    df: DataFrame, keys: Sequence[str] = ("restaurant_id",), date_col: str = "review_date"
) -> DataFrame:
    """First and last date per entity."""
    return df.groupBy(*keys).agg(
        F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date")
    )


def restaurants(
    df: DataFrame, attributes: Sequence[str] = ("restaurant_name", "county"), date_col: str = "review_date"
) -> DataFrame:
    """One row per restaurant: its latest attributes and its active span.

    Latest means from the row with the greatest date; the greatest attribute
    values decide between several on that date. The first grouping touches
    dates only and hashes; the one that compares text sees one row per
    spelling of a restaurant.
    """
    spellings = active_span(df, ("restaurant_id", *attributes), date_col)
    return merge_restaurants(spellings, attributes)


def merge_restaurants(
    parts: DataFrame,
    attributes: Sequence[str] = ("restaurant_name", "county"),
    keys: Sequence[str] = ("restaurant_id",),
) -> DataFrame:
    """Combine several rows per restaurant into one. Order and repetition do not matter."""
    return (
        parts.groupBy(*keys)
        .agg(
            F.min("first_date").alias("first_date"),
            F.max(F.struct("last_date", *attributes)).alias("latest"),
        )
        .select(
            *keys,
            *(F.col(f"latest.{name}").alias(name) for name in attributes),
            "first_date",
            F.col("latest.last_date").alias("last_date"),
        )
    )


def merge_spans(parts: DataFrame, keys: Sequence[str] = ("restaurant_id",)) -> DataFrame:
    """The active spans alone of :func:`merge_restaurants`, without comparing text."""
    return parts.groupBy(*keys).agg(
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date")
    )


def touched_dates(
    df: DataFrame, date_col: str = "review_date", usable_col: str | None = None
) -> DataFrame:
    """The distinct dates of a batch with their row counts.

    With a boolean ``usable_col`` the rows where it is true are counted too.
    """
    counts = [F.count(F.lit(1)).alias("n_rows")]
    if usable_col:
        counts.append(F.count_if(usable_col).alias("n_usable"))
    return df.groupBy(date_col).agg(*counts)
