from tablepulse.functions.columns import (
    as_id,
    day,
    days_around,
    days_from,
    parse_compact_date,
    ratio,
)

__all__ = ["as_id", "day", "days_around", "days_from", "parse_compact_date", "ratio"]
