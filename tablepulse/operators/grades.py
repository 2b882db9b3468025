"""Daily health grades from periodic inspections."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablepulse.functions import day
from tablepulse.operators.calendar import densify


def daily_grade(health: DataFrame) -> DataFrame:
    """One grade per restaurant and day: the highest, where a day has several."""
    return health.groupBy("restaurant_id", "grade_date").agg(
        F.max("health_grade").alias("health_grade")
    )


def forward_fill(df: DataFrame, keys, date_col: str, column: str) -> DataFrame:
    """Replace each null in ``column`` by the last value before it in the entity's series."""
    so_far = (
        Window.partitionBy(*keys).orderBy(date_col).rowsBetween(Window.unboundedPreceding, 0)
    )
    return df.withColumn(column, F.last(column, ignorenulls=True).over(so_far))


def forward_fill_grades(
    health: DataFrame, until: date | None = None, only: tuple[date, date] | None = None
) -> DataFrame:
    """The grade in force on every day from a restaurant's first inspection to its last.

    The fill runs over the inspections, before the days between them exist, so
    the window sorts the small side; each inspection is then carried forward.
    """
    inspections = forward_fill(
        daily_grade(health), ("restaurant_id",), "grade_date", "health_grade"
    )
    return densify(
        inspections,
        ("restaurant_id",),
        "grade_date",
        carry=("health_grade",),
        until=until,
        only=only,
    )


def _runs(states: DataFrame) -> DataFrame:
    """Runs from one row per restaurant and day.

    ``own`` is the grade of that day's inspection or null, ``carried`` what was in force
    before the first row of a series that is not read from its beginning.
    """
    series = Window.partitionBy("restaurant_id").orderBy("grade_date")
    so_far = series.rowsBetween(Window.unboundedPreceding, 0)
    given = F.when(
        F.col("own").isNotNull(),
        F.struct(F.col("grade_date").alias("graded_on"), F.col("own").alias("health_grade")),
    ).otherwise(F.col("carried"))
    return states.select(
        "restaurant_id",
        F.last(given, ignorenulls=True).over(so_far).alias("given"),
        F.date_sub(F.lead("grade_date").over(series), 1).alias("valid_to"),
        F.col("grade_date").alias("valid_from"),
    ).select("restaurant_id", "given.health_grade", "given.graded_on", "valid_to", "valid_from")


_CARRIED = "struct<graded_on: date, health_grade: int>"


def grade_runs(health: DataFrame) -> DataFrame:
    """One row per restaurant and inspection day: the grade in force from then on.

    It holds from ``valid_from`` to ``valid_to``, the day before the next inspection; the
    last run of a restaurant is open (null). ``graded_on`` is the inspection that gave the
    grade: an earlier one where an inspection gave none, null where none has yet.
    """
    states = daily_grade(health).select(
        "restaurant_id",
        "grade_date",
        F.col("health_grade").alias("own"),
        F.lit(None).cast(_CARRIED).alias("carried"),
    )
    return _runs(states)


def updated_runs(runs: DataFrame, batch: DataFrame, start: date) -> DataFrame:
    """The runs that ``batch``, whose first inspection is on ``start``, adds or changes.

    ``runs`` has at least those stored ones of the batch's restaurants that are open or
    reach the day before ``start``: each begins with what was in force then, so earlier
    inspections are not needed. A run whose day had no inspection of its own grade takes
    the grade before it anew.
    """
    held = F.struct("graded_on", "health_grade").cast(_CARRIED)
    stored = runs.select(
        "restaurant_id",
        F.col("valid_from").alias("grade_date"),
        F.when(F.col("graded_on") == F.col("valid_from"), F.col("health_grade")).alias("own"),
        F.when(
            (F.col("valid_from") < day(start)) & F.col("graded_on").isNotNull(), held
        ).alias("carried"),
    )
    fresh = daily_grade(batch).select(
        "restaurant_id",
        "grade_date",
        F.col("health_grade").alias("own"),
        F.lit(None).cast(_CARRIED).alias("carried"),
    )
    states = stored.unionByName(fresh).groupBy("restaurant_id", "grade_date")
    merged = states.agg(F.max("own").alias("own"), F.max("carried").alias("carried"))
    new = _runs(merged)
    known = runs.select(*(F.col(name).alias(f"_{name}") for name in new.columns))
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in new.columns]
    return new.join(known, reduce(and_, same), "left_anti")


def days_of_runs(runs: DataFrame) -> DataFrame:
    """The grade of every day, from each restaurant's first inspection to its last."""
    last_day = F.coalesce("valid_to", "valid_from")
    return runs.select(
        "restaurant_id",
        "health_grade",
        F.explode(F.sequence("valid_from", last_day)).alias("grade_date"),
    )
