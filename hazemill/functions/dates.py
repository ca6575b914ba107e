"""Calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def time_bucket(hour: Column | str) -> Column:
    """Part of the day. The four Vietnamese labels."""
    h = _column(hour)
    return (
        F.when(h.between(6, 11), "Sáng")
        .when(h.between(12, 17), "Chiều")
        .when(h.between(18, 21), "Tối")
        .otherwise("Đêm")
    )


def day_of_week(day: Column | str) -> Column:
    """'0' for Monday to '6' for Sunday."""
    return F.weekday(_column(day)).cast("string")


def is_weekend(day: Column | str) -> Column:
    return F.weekday(_column(day)) >= 5


def iso_week(day: Column | str) -> Column:
    return F.weekofyear(_column(day))


def wall_clock(text: Column | str, strict: bool = False) -> Column:
    """ISO local time as TIMESTAMP_NTZ, so that no session zone shifts it.

    Text that is no time gives null, or an error with ``strict``.
    """
    c = _column(text)
    return c.cast("timestamp_ntz") if strict else c.try_cast("timestamp_ntz")
