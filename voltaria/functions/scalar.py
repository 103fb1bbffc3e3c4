"""Null- and zero-safe scalar expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_HOUR = 3.6e9


def clip(x: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a number; a null stays null (``least`` and ``greatest`` would skip it)."""
    bounded = x
    if low is not None:
        bounded = F.greatest(bounded, F.lit(float(low)))
    if high is not None:
        bounded = F.least(bounded, F.lit(float(high)))
    return F.when(x.isNotNull(), bounded)


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, null on a zero or null denominator."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def hours_between(start: Column, end: Column) -> Column:
    """Elapsed hours between two timestamps."""
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(MICROS_PER_HOUR)


def finite(x: Column) -> Column:
    """NaN and infinities become null: Spark sorts NaN above every number and lets it poison averages."""
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def in_hour_ranges(hour: Column, ranges: Iterable[tuple[int, int]]) -> Column:
    """Whether an hour lies in any ``[start, end)`` range."""
    test = F.lit(False)
    for start, end in ranges:
        test = test | ((hour >= start) & (hour < end))
    return test


def parse_timestamp(text: Column, pattern: str | None = None) -> Column:
    """Timestamp from text; what cannot be parsed becomes null instead of failing the job."""
    parsed = F.try_to_timestamp(text) if pattern is None else F.try_to_timestamp(text, F.lit(pattern))
    return parsed.cast("timestamp_ntz")


def timestamp_from_parts(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column) -> Column:
    """Timestamp from its calendar parts, without a zone."""
    return F.try_make_timestamp_ntz(year, month, day, hour, minute, second.cast("decimal(16,6)"))
