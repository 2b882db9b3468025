"""Explicit schemas for every read, so that no read infers a type.

Ids stay strings throughout: an inferred id would lose leading zeros and fail
on letters.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


# Holds the text of a line that does not fit the header of its file; null for all others.
MALFORMED = "_malformed"


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in fields.items()])


# Raw files are read as text: the archive keeps them as they came, and a bad
# value can be reported with the text that caused it.
RAW_REVIEWS = _struct(
    review_id=StringType,
    review_date=StringType,
    restaurant_id=StringType,
    restaurant_name=StringType,
    county=StringType,
    rating=StringType,
    reviewer_name=StringType,
    comments=StringType,
    operation=StringType,
)
RAW_HEALTH = _struct(
    grade_date=StringType,
    restaurant_id=StringType,
    restaurant_name=StringType,
    cuisine=StringType,
    county=StringType,
    health_grade=StringType,
)

REVIEWS = _struct(
    review_id=StringType,
    restaurant_id=StringType,
    restaurant_name=StringType,
    county=StringType,
    rating=IntegerType,
    reviewer_name=StringType,
    comments=StringType,
    operation=StringType,
    review_date=DateType,
)
HEALTH = _struct(
    restaurant_id=StringType,
    restaurant_name=StringType,
    cuisine=StringType,
    county=StringType,
    health_grade=IntegerType,
    grade_date=DateType,
)

# Stored facts carry no names. Those live in the restaurants table and are
# joined on read, so a renamed restaurant never rewrites its history.
RATING_SUM = _struct(
    restaurant_id=StringType,
    rating_sum=LongType,
    rating_count=LongType,
    review_count=LongType,
    review_date=DateType,
)
# Reviews by rating, null among them, for each day.
RATING_HISTOGRAM = _struct(
    rating=IntegerType,
    n=LongType,
    review_date=DateType,
)
FINAL_RATING = _struct(
    restaurant_id=StringType,
    rating_sum=LongType,
    rating_count=LongType,
    final_rating=DoubleType,
    review_date=DateType,
)
GRADE_VALUES = _struct(
    restaurant_id=StringType,
    health_grade=IntegerType,
    grade_date=DateType,
)
# One row per restaurant and inspection day, see operators.grades.grade_runs.
GRADE_RUNS = _struct(
    restaurant_id=StringType,
    health_grade=IntegerType,
    graded_on=DateType,
    valid_to=DateType,
    valid_from=DateType,
)

# One row per restaurant and batch, see operators.restaurants.
REVIEW_RESTAURANTS = _struct(
    restaurant_id=StringType,
    restaurant_name=StringType,
    county=StringType,
    first_date=DateType,
    last_date=DateType,
    batch=StringType,
)
HEALTH_RESTAURANTS = _struct(
    restaurant_id=StringType,
    restaurant_name=StringType,
    cuisine=StringType,
    county=StringType,
    first_date=DateType,
    last_date=DateType,
    batch=StringType,
)


def with_site(schema: StructType) -> StructType:
    """The schema of a table over all sites."""
    return StructType([*schema.fields, StructField("site", StringType())])
