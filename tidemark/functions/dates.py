"""Date column builders."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Output formats of month keys and labels.
MONTH_KEY = "yyyy-MM"
MONTH_DISPLAY = "MMM yyyy"
WEEKDAY = "EEEE"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def parse_date(column: Column | str, fmt: str | None = None) -> Column:
    """Date, or NULL where the value is no date."""
    return F.try_to_date(_col(column), fmt) if fmt else F.try_to_date(_col(column))


def parse_timestamp(column: Column | str, fmt: str | None = None) -> Column:
    """Timestamp, or NULL where the value is no timestamp."""
    if fmt:
        return F.try_to_timestamp(_col(column), F.lit(fmt))
    return F.try_to_timestamp(_col(column))


def year(column: Column | str) -> Column:
    return F.year(_col(column))


def month(column: Column | str) -> Column:
    return F.month(_col(column))


def day(column: Column | str) -> Column:
    return F.dayofmonth(_col(column))


def day_name(column: Column | str) -> Column:
    return F.date_format(_col(column), WEEKDAY)


def weekday_number(column: Column | str) -> Column:
    """Monday is 0, Sunday is 6."""
    return F.weekday(_col(column))


def is_weekend(column: Column | str) -> Column:
    return F.coalesce(F.weekday(_col(column)) >= 5, F.lit(False))


def month_start(column: Column | str) -> Column:
    return F.trunc(_col(column), "MM")


def month_end(column: Column | str) -> Column:
    return F.last_day(_col(column))


def month_text(column: Column | str) -> Column:
    """``2024-03``; sorts like the month itself."""
    return F.date_format(_col(column), MONTH_KEY)


def month_label(column: Column | str) -> Column:
    """``Mar 2024``, for display."""
    return F.date_format(_col(column), MONTH_DISPLAY)
