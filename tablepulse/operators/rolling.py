"""Rolling rating over the dense daily series."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablepulse.functions import ratio
from tablepulse.operators.calendar import densify
from tablepulse.operators.rollups import daily_rating

WINDOW_DAYS = 7
SERIES = ("restaurant_id",)
TOTAL, NUMBER, RECENT = "_total", "_number", "_recent"


def rolling_rating(
    daily: DataFrame, days: int = WINDOW_DAYS, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Add ``final_rating``: the mean of all ratings in the last ``days`` rows of a series.

    ``daily`` must be dense (see :func:`densify`), so that rows are days. It is
    null, not an error, when there is no rating in the window. Where the rows carry
    their :func:`running_totals`, these give the same without sorting the days.
    """
    if RECENT in daily.columns:
        first_day = F.date_sub("review_date", days - 1)
        oldest = F.get(F.filter(RECENT, lambda row: row["day"] >= first_day), 0)
        marked = daily.withColumn(RECENT, oldest)
        total = F.col(TOTAL) - F.col(f"{RECENT}.total")
        number = F.col(NUMBER) - F.col(f"{RECENT}.number")
        return marked.withColumn("final_rating", ratio(total, number)).drop(TOTAL, NUMBER, RECENT)
    recent = Window.partitionBy(*keys).orderBy("review_date").rowsBetween(1 - days, 0)
    total, number = F.sum("rating_sum").over(recent), F.sum("rating_count").over(recent)
    return daily.withColumn("final_rating", ratio(total, number))


def running_totals(
    daily: DataFrame, days: int = WINDOW_DAYS, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Add the totals of a series up to each row, and those before each of its last ``days`` rows.

    ``daily`` has one row per review day of a series, so that no row before the last
    ``days`` is in a window. A difference of two totals is the sum of a window.
    """
    series = Window.partitionBy(*keys).orderBy("review_date")
    so_far, last = series.rowsBetween(Window.unboundedPreceding, 0), series.rowsBetween(1 - days, 0)
    own = {TOTAL: F.coalesce("rating_sum", F.lit(0)), NUMBER: F.coalesce("rating_count", F.lit(0))}
    summed = daily.withColumns({name: F.sum(value).over(so_far) for name, value in own.items()})
    before = F.struct(
        F.col("review_date").alias("day"),
        (F.col(TOTAL) - own[TOTAL]).alias("total"),
        (F.col(NUMBER) - own[NUMBER]).alias("number"),
    )
    return summed.withColumn(RECENT, F.collect_list(before).over(last))


def rated_days(
    daily: DataFrame, days: int = WINDOW_DAYS, keys: Sequence[str] = SERIES, beyond: bool = True
) -> DataFrame:
    """The days that carry information, with their rolling rating.

    ``daily`` has one row per review day of a series. The result has these days and
    the ``days - 1`` after each; on every other day of the dense series nothing was
    counted and ``final_rating`` is null. One shuffle, and work that follows the number
    of review days, not the length of the series. Without ``beyond`` the days after the
    last review day, by which a later batch may lengthen the series, are left out.
    """
    near = densify(
        daily,
        keys,
        "review_date",
        {"rating_sum": 0, "rating_count": 0},
        reach=days - 1,
        beyond=beyond,
    )
    number_of_day = F.unix_date("review_date")
    recent = Window.partitionBy(*keys).orderBy(number_of_day).rangeBetween(1 - days, 0)
    total, number = F.sum("rating_sum").over(recent), F.sum("rating_count").over(recent)
    return near.withColumn("final_rating", ratio(total, number))


def rating_timeline(
    reviews: DataFrame,
    days: int = WINDOW_DAYS,
    keys: Sequence[str] = SERIES,
    until: date | None = None,
) -> DataFrame:
    """Reviews to the dense daily series with the rolling rating, without names.

    A series is keyed by the restaurant (and the site, where ``keys`` name it),
    so a restaurant that changes its name keeps one series. Two shuffles: daily
    totals by series and day, then by series; filling the gaps and rolling both
    use the second, where a series has at most one row per day. Only review days are
    sorted; the days between them carry the totals of the row before.
    """
    daily = running_totals(daily_rating(reviews, keys), days, keys)
    dense = densify(
        daily,
        keys,
        "review_date",
        {"rating_sum": 0, "rating_count": 0},
        carry=(TOTAL, NUMBER, RECENT),
        until=until,
    )
    return rolling_rating(dense, days, keys)


def attach_restaurants(
    facts: DataFrame, restaurants: DataFrame, *attributes: str, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Join the named attributes onto facts by restaurant.

    The facts keep all their rows. Spark chooses the join from the size of the
    restaurants table, and a series that was just built is already partitioned
    by restaurant.
    """
    return facts.join(restaurants.select(*keys, *attributes), list(keys), "left")
