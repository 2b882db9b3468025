"""Which dates a batch of reviews changes, and which stored days are needed to recompute them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablepulse.functions import days_around, days_from
from tablepulse.operators.rolling import WINDOW_DAYS


def affected_dates(
    touched: DataFrame, days: int = WINDOW_DAYS, date_col: str = "review_date"
) -> DataFrame:
    """All dates that play a part in a recomputation, one row each.

    ``is_touched``  the batch has reviews on this date
    ``is_output``   the rolling rating can change: a review counts on its own
                    day and the ``days - 1`` that follow
    Every row is needed as input: an output date and the ``days - 1`` before it. A batch
    that lengthens a series adds no further dates, as days without information are not
    stored.
    """
    marks = touched.select(F.col(date_col).alias("day")).where("day is not null").distinct()
    outputs = marks.select("day", F.explode(days_from("day", days - 1)).alias("output_day"))
    inputs = outputs.select("*", F.explode(days_around("output_day", days - 1, 0)).alias(date_col))
    return inputs.groupBy(date_col).agg(
        F.max(F.col("day") == F.col(date_col)).alias("is_touched"),
        F.max(F.col("output_day") == F.col(date_col)).alias("is_output"),
    )
