"""Insight queries over finished series and reviews of several sites."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablepulse.functions import day as as_day
from tablepulse.functions import ratio
from tablepulse.operators.asof import as_of_join


def _pearson(left: str, right: str) -> Column:
    """Pearson's r, or null where a series is constant and r is not defined."""
    spread = F.stddev_pop(left) * F.stddev_pop(right)
    return F.try_divide(F.covar_pop(left, right), F.nullif(spread, F.lit(0.0)))


def ratings_with_grades(final_rating: DataFrame, runs: DataFrame) -> DataFrame:
    """The rated days of a series with the grade in force on them, per restaurant.

    ``runs`` are those of :func:`tablepulse.operators.grades.grade_runs`. Neither side has
    to be dense: days without a rating can be left out of the one, and a run stands for
    all its days.
    """
    last_day = F.coalesce("valid_to", "valid_from")
    return as_of_join(
        final_rating,
        runs,
        ["restaurant_id"],
        "review_date",
        "valid_from",
        last_day,
        ["health_grade"],
    )


def rating_hygiene_correlation(
    final_rating: DataFrame, runs: DataFrame, per_restaurant: bool = False
) -> DataFrame:
    """Correlation of rolling rating and health grade, per site or per site and restaurant."""
    keys = ["site", "restaurant_id"] if per_restaurant else ["site"]
    rated = final_rating.where("final_rating is not null")
    both = ratings_with_grades(rated, runs).where("health_grade is not null")
    pairs = both.select(
        *keys, "final_rating", F.col("health_grade").cast("double").alias("health_grade")
    )
    return pairs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_days"), _pearson("final_rating", "health_grade").alias("r")
    )


def correlation_sums(final_rating: DataFrame, runs: DataFrame) -> DataFrame:
    """What the correlation of a site needs to know of each day, one row a site and day.

    Days can be stored and replaced one by one, as with ``replace_dates``;
    :func:`correlation_of_sums` adds up any of them, in any order.
    """
    rated = final_rating.where("final_rating is not null")
    both = ratings_with_grades(rated, runs).where("health_grade is not null")
    x, y = F.col("final_rating"), F.col("health_grade").cast("double")
    return both.groupBy("site", "review_date").agg(
        F.count(F.lit(1)).alias("n_days"),
        F.sum(x).alias("x"),
        F.sum(y).alias("y"),
        F.sum(x * x).alias("xx"),
        F.sum(y * y).alias("yy"),
        F.sum(x * y).alias("xy"),
        F.min(x).alias("least_x"),
        F.max(x).alias("most_x"),
        F.min(y).alias("least_y"),
        F.max(y).alias("most_y"),
    )


def correlation_of_sums(sums: DataFrame) -> DataFrame:
    """The same as :func:`rating_hygiene_correlation` per site, from stored sums."""
    total = sums.groupBy("site").agg(
        *(F.sum(name).alias(name) for name in ("n_days", "x", "y", "xx", "yy", "xy")),
        *(F.min(name).alias(name) for name in ("least_x", "least_y")),
        *(F.max(name).alias(name) for name in ("most_x", "most_y")),
    )
    # Rounding may leave a spread in the sums of a constant series; its limits tell.
    varied = (F.col("least_x") < F.col("most_x")) & (F.col("least_y") < F.col("most_y"))
    r = F.expr("try_divide(n_days * xy - x * y, sqrt(n_days * xx - x * x) * sqrt(n_days * yy - y * y))")
    return total.select("site", "n_days", F.when(varied, r).alias("r"))


def quality_timeline(
    final_rating: DataFrame,
    grades: DataFrame,
    first_day: date | None = None,
    last_day: date | None = None,
) -> DataFrame:
    """Rating and grade per restaurant, site and day; days with only one of them are kept.

    A grade belongs to no site and appears on each site's row of its day, or
    on one row without a site. The date range is applied to both inputs, where
    it prunes date partitions.
    """
    rated = final_rating.select(
        "restaurant_id", F.col("review_date").alias("day"), "site", "final_rating"
    )
    graded = grades.select("restaurant_id", F.col("grade_date").alias("day"), "health_grade")
    for bound, keep in (
        (first_day, lambda limit: F.col("day") >= as_day(limit)),
        (last_day, lambda limit: F.col("day") <= as_day(limit)),
    ):
        if bound is not None:
            rated, graded = rated.where(keep(bound)), graded.where(keep(bound))
    return rated.join(graded, ["restaurant_id", "day"], "full_outer")


def cuisine_site_counts(reviews: DataFrame, cuisines: DataFrame) -> DataFrame:
    """Number of reviews per cuisine and site.

    ``cuisines`` has one row per restaurant. Reviews are counted per restaurant
    before the join, so a much-reviewed restaurant brings one row to it.
    Reviews of restaurants without a known cuisine count under null.
    """
    per_restaurant = reviews.groupBy("restaurant_id", "site").agg(
        F.count(F.lit(1)).alias("n_reviews")
    )
    return counts_by_cuisine(per_restaurant, cuisines)


def counts_by_cuisine(per_restaurant: DataFrame, cuisines: DataFrame) -> DataFrame:
    """The same from ``n_reviews`` per restaurant and site."""
    return (
        per_restaurant.join(cuisines.select("restaurant_id", "cuisine"), "restaurant_id", "left")
        .groupBy("cuisine", "site")
        .agg(F.sum("n_reviews").alias("n_reviews"))
    )


def cross_site_outliers(reviews: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Mean rating per restaurant and site beside the mean over all sites.

    ``is_outlier`` marks a site whose mean is at least ``threshold`` away. The
    window sees one row per restaurant and site.
    """
    per_site = reviews.groupBy("restaurant_id", "site").agg(
        F.sum("rating").alias("rating_sum"), F.count("rating").alias("rating_count")
    )
    return outliers_of_totals(per_site, threshold)


def outliers_of_totals(per_site: DataFrame, threshold: float = 1.0) -> DataFrame:
    """The same from ``rating_sum`` and ``rating_count`` per restaurant and site."""
    restaurant = Window.partitionBy("restaurant_id")
    means = per_site.select(
        "restaurant_id",
        "site",
        "rating_count",
        ratio("rating_sum", "rating_count").alias("site_mean"),
        ratio(
            F.sum("rating_sum").over(restaurant), F.sum("rating_count").over(restaurant)
        ).alias("overall_mean"),
    )
    far = F.abs(F.col("site_mean") - F.col("overall_mean")) >= F.lit(float(threshold))
    return means.withColumn("is_outlier", far)


def histogram_profile(histogram: DataFrame, value: str, n: str = "n") -> DataFrame:
    """Count, mean, deviation, extremes and quartiles from counts by value.

    Histograms of any parts can be put together first: counts of one value add up, and
    all statistics but the mean and the deviation are exact integers. The window runs over
    one row a value. Null values do not count. One row a statistic.
    """
    counts = histogram.where(F.col(value).isNotNull()).groupBy(value).agg(F.sum(n).alias("n"))
    upto = Window.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(F.lit(0))
    placed = counts.select(
        F.col(value).alias("x"),
        "n",
        F.sum("n").over(upto).alias("upto"),
        F.sum("n").over(every).alias("total"),
    )
    x, times = F.col("x").cast("double"), F.col("n")
    count, total = F.sum("n"), F.sum(F.col("x") * times).cast("double")
    mean = F.try_divide(total, count.cast("double"))
    squares = F.sum(x * x * times) - total * mean
    spread = F.sqrt(F.greatest(squares, F.lit(0.0)) / F.nullif(count - 1, F.lit(0)))

    def quartile(share: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.col("total") * F.lit(share), x))

    statistics = {
        "count": F.coalesce(count, F.lit(0)).cast("double"),
        "mean": mean,
        "stddev": spread,
        "min": F.min(x),
        "25%": quartile(0.25),
        "50%": quartile(0.5),
        "75%": quartile(0.75),
        "max": F.max(x),
    }
    pairs = placed.agg(
        F.array(
            *(
                F.struct(F.lit(name).alias("statistic"), found.alias(value))
                for name, found in statistics.items()
            )
        ).alias("rows")
    )
    return pairs.select(F.inline("rows"))


def column_profile(df: DataFrame, *columns: str) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of each column, in one pass."""
    return df.select(*columns).summary()


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in the given order. Each task keeps at most ``n``."""
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The last ``n`` rows in the given order."""
    return df.orderBy(*(F.desc(name) for name in order)).limit(n)
