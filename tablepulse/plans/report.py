"""What a batch consisted of."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Row

logger = logging.getLogger("tablepulse")


class BatchReport(NamedTuple):
    batch_key: str
    rows: int
    rejected: int
    dates: int


def batch_report(batch_key: str, days_seen: Iterable[Row]) -> BatchReport:
    """Sum up the rows of ``touched_dates`` and log them."""
    days_seen = list(days_seen)
    rows = sum(row["n_rows"] for row in days_seen)
    good = sum(row["n_usable"] for row in days_seen)
    report = BatchReport(batch_key, rows, rows - good, sum(row["n_usable"] > 0 for row in days_seen))
    logger.info("%s", report)
    return report
