"""Gap-free daily series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablepulse.functions import day
from tablepulse.operators.rollups import active_span


def daily_calendar(df: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    """Every day from the first to the last date of each entity."""
    return active_span(df, keys, date_col).select(
        *keys,
        F.explode(F.sequence("first_date", "last_date", F.expr("interval 1 day"))).alias(date_col),
    )


def join_calendar(
    calendar: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    fill: Mapping[str, int] | None = None,
) -> DataFrame:
    """Left join of a calendar with facts on all ``keys``, nulls filled by ``fill``.

    For a calendar that comes from elsewhere. Where calendar and facts come
    from one frame, :func:`densify` gives the same rows without the join.
    """
    joined = calendar.join(facts, list(keys), "left")
    return joined.fillna(dict(fill)) if fill else joined


def densify(
    df: DataFrame,
    keys: Sequence[str],
    date_col: str,
    fill: Mapping[str, int] | None = None,
    carry: Sequence[str] = (),
    until: date | None = None,
    only: tuple[date, date] | None = None,
    reach: int | None = None,
    beyond: bool = True,
) -> DataFrame:
    """Add a row for every missing day between the rows of each entity.

    On an added row the ``fill`` columns take their given value, the ``carry``
    columns keep the value of the row before, all others are null. ``fill``
    also replaces nulls on the rows that exist, as a filled left join does.
    ``until`` extends each series beyond its own last date; ``only`` emits the
    days of a closed range and skips the rest before they are made. With ``reach``
    only the days that lie at most so many after a row are added, also after the
    last one unless ``beyond`` is false.

    Each row is spread up to the day before the next one. This needs one
    shuffle by ``keys`` and neither a second grouping nor a join, and it leaves
    the rows partitioned by ``keys`` for a window that follows. An entity's
    rows in one task are bounded by the days of its span once the input has one
    row per entity and day.
    """
    fill = dict(fill or {})
    series = Window.partitionBy(*keys).orderBy(date_col)
    day_before_next = F.date_sub(F.lead(date_col).over(series), 1)
    end_of_series = day(until) if until else F.col(date_col)
    first_day = F.col(date_col)
    last_day = F.greatest(F.col(date_col), F.coalesce(day_before_next, end_of_series))
    if reach is not None:
        within = F.date_add(date_col, reach)
        end = within if beyond else F.col(date_col)
        last_day = F.least(within, F.coalesce(day_before_next, end))
    if only:
        first_day = F.greatest(first_day, day(only[0]))
        last_day = F.least(last_day, day(only[1]))
    spread = df.withColumns({"_first_day": first_day, "_last_day": last_day})
    if only:
        spread = spread.where(F.col("_first_day") <= F.col("_last_day"))
    spread = spread.select("*", F.explode(F.sequence("_first_day", "_last_day")).alias("_day"))

    is_row = F.col("_day") == F.col(date_col)

    def value(name: str):
        if name in keys or name in carry:
            return F.col(name)
        if name == date_col:
            return F.col("_day").alias(date_col)
        if name in fill:
            given = F.lit(fill[name]).cast(df.schema[name].dataType)
            return F.when(is_row, F.coalesce(F.col(name), given)).otherwise(given).alias(name)
        return F.when(is_row, F.col(name)).alias(name)

    return spread.select(*(value(name) for name in df.columns))
