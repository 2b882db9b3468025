"""As-of join: events meet the interval in force, without spreading either over days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of_join(
    events: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    time: str,
    valid_from: str,
    valid_to: Column,
    values: Sequence[str],
) -> DataFrame:
    """Each event with ``values`` of the latest interval that began by its ``time``.

    Events after ``valid_to`` of that interval, before the first one, or with a null key
    or time are left out. Both sides are put into one sorted run per key, where the last
    interval seen is carried along: one shuffle of the rows there are, whatever the length
    of an interval, and a key's rows pass by in order without being held.
    """
    found = F.struct(valid_to.alias("until"), *values).alias("_interval")
    begins = intervals.select(*keys, F.col(valid_from).alias(time), F.lit(0).alias("_turn"), found)
    kind = begins.schema["_interval"].dataType
    tagged = events.withColumns({"_turn": F.lit(1), "_interval": F.lit(None).cast(kind)})
    known = F.col(time).isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    both = tagged.where(known).unionByName(begins.where(known), allowMissingColumns=True)
    # On its first day an interval comes before the events of that day.
    run = Window.partitionBy(*keys).orderBy(time, "_turn")
    so_far = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = both.withColumn("_interval", F.last("_interval", ignorenulls=True).over(so_far))
    in_force = (F.col("_turn") == 1) & (F.col(time) <= F.col("_interval.until"))
    return carried.where(in_force).select(
        *events.columns, *(F.col(f"_interval.{name}").alias(name) for name in values)
    )
