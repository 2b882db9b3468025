"""Raw text rows to typed rows, and the rows that cannot be used."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepulse.functions import as_id, day, parse_compact_date
from tablepulse.schemas import HEALTH, MALFORMED, REVIEWS


def _stamped(raw: DataFrame, date_col: str) -> Column:
    """The date of a raw row; null, so that the row is rejected, where its line is malformed."""
    parsed = parse_compact_date(date_col)
    return F.when(F.col(MALFORMED).isNull(), parsed) if MALFORMED in raw.columns else parsed


def normalize_reviews(raw: DataFrame) -> DataFrame:
    """Typed reviews in stored column order.

    A rating that is no number becomes null (not counted later). Rows without
    a date or a restaurant are kept here; see :func:`usable`.
    """
    return raw.select(
        "review_id",
        as_id("restaurant_id").alias("restaurant_id"),
        "restaurant_name",
        "county",
        F.col("rating").try_cast("int").alias("rating"),
        "reviewer_name",
        "comments",
        "operation",
        _stamped(raw, "review_date").alias("review_date"),
    ).to(REVIEWS)


def normalize_health(raw: DataFrame) -> DataFrame:
    """Typed health grades in stored column order."""
    return raw.select(
        as_id("restaurant_id").alias("restaurant_id"),
        "restaurant_name",
        "cuisine",
        "county",
        F.col("health_grade").try_cast("int").alias("health_grade"),
        _stamped(raw, "grade_date").alias("grade_date"),
    ).to(HEALTH)


def usable(date_col: str, plausible: tuple[date, date] | None = None) -> Column:
    """True where a normalized row has the two keys that every later step needs.

    ``plausible`` also turns away dates outside a closed range: one review dated
    to the wrong century would give its restaurant a calendar of that length.
    """
    known = F.col(date_col).isNotNull() & F.col("restaurant_id").isNotNull()
    if plausible:
        first, last = plausible
        known = known & F.coalesce(F.col(date_col).between(day(first), day(last)), F.lit(False))
    return known


def rejected(raw: DataFrame, date_col: str, plausible: tuple[date, date] | None = None) -> DataFrame:
    """The raw rows that :func:`usable` turns away, with their text unchanged."""
    parsed = raw.select(
        F.struct(*raw.columns).alias("row"),
        _stamped(raw, date_col).alias(date_col),
        "restaurant_id",
    )
    return parsed.where(~usable(date_col, plausible)).select("row.*")
