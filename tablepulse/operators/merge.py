"""Set-union merge, date filters and partition replacement, as pure transforms."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepulse.functions import day

Dates = Iterable[date] | DataFrame

def listed(date_col: str, dates: Iterable[date]) -> Column:
    """True where the date is one of ``dates``; literals only, so that partitions are pruned.

    Spark looks the literals up as a set; the first and the last of them bound the
    scan where only minimum and maximum are known.
    """
    days = sorted(set(dates))
    if not days:
        return F.lit(False)
    literals = ", ".join(f"DATE'{d.isoformat()}'" for d in days)
    inside = F.col(date_col).between(day(days[0]), day(days[-1]))
    return inside & F.expr(f"`{date_col}` IN ({literals})")


def _date_side(dates: DataFrame, date_col: str) -> DataFrame:
    """Distinct dates, no more than the calendar has days; Spark broadcasts them if small."""
    return dates.toDF(date_col).select(F.col(date_col).cast("date")).distinct()


def in_dates(df: DataFrame, date_col: str, dates: Dates) -> DataFrame:
    """Rows on the given dates.

    A list becomes literals, which prune partitions at planning time. A
    one-column frame becomes a semi join, for dates that were never collected.
    """
    if isinstance(dates, DataFrame):
        return df.join(_date_side(dates, date_col), date_col, "left_semi").select(df.columns)
    return df.where(listed(date_col, dates))


def not_in_dates(df: DataFrame, date_col: str, dates: Dates, keep_null: bool = False) -> DataFrame:
    """Rows on any other date. As in SQL ``NOT IN``, a null date is dropped unless kept."""
    if isinstance(dates, DataFrame):
        rest = df.join(_date_side(dates, date_col), date_col, "left_anti").select(df.columns)
        return rest if keep_null else rest.where(F.col(date_col).isNotNull())
    other = ~listed(date_col, dates)
    return df.where(other | F.col(date_col).isNull() if keep_null else other)


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name."""
    for other in others:
        first = first.unionByName(other)
    return first


def set_union(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The distinct rows of both frames.

    Rows are equal only if all columns are: a changed review with a known id is
    another row. Copies collapse within each map task before the shuffle, so
    many copies of one row do not gather anywhere.
    """
    return union_all(stored, batch).distinct()


def new_rows(stored: DataFrame, batch: DataFrame, match_on: str) -> DataFrame:
    """The distinct rows of ``batch`` that ``stored`` does not have.

    Only stored rows that share a ``match_on`` value with the batch are compared
    in full; for a small batch that is a filter on the scan of ``stored``. Nulls
    compare as equal, as in a set union.
    """
    fresh = batch.distinct()
    wanted = batch.select(F.col(match_on).alias("_wanted")).distinct()
    candidates = stored.join(wanted, F.col(match_on).eqNullSafe(F.col("_wanted")), "left_semi")
    known = candidates.select(*(F.col(name).alias(f"_{name}") for name in batch.columns))
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in batch.columns]
    return fresh.join(known, reduce(and_, same), "left_anti")


def merge_partitions(
    stored: DataFrame, batch: DataFrame, date_col: str, dates: Dates, match_on: str | None = None
) -> DataFrame:
    """New content of the date partitions that ``batch`` touches: the set union of both.

    With ``match_on``, a column that narrows the comparison, stored rows are
    taken to be distinct already and pass through without being shuffled or
    compared among themselves.
    """
    kept = in_dates(stored, date_col, dates)
    if match_on is None:
        return set_union(kept, batch)
    return union_all(kept, new_rows(kept, batch, match_on))


def replace_dates(
    existing: DataFrame, recomputed: DataFrame, date_col: str, dates: Dates
) -> DataFrame:
    """``existing`` with all rows on ``dates`` replaced by ``recomputed``."""
    return union_all(not_in_dates(existing, date_col, dates, keep_null=True), recomputed)
