"""Scalar expressions of the tick queries; all of them stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# From here on every double is a whole number already.
_WHOLE_FROM = float(2**53)

# Timestamps count microseconds in 64 bits.
_MAX_MILLIS = (2**63 - 1) // 1000


def event_time(millis: str | Column) -> Column:
    """Epoch milliseconds to a zoned timestamp.

    A number that no timestamp can hold gives null; failing on it would let one bad
    message stop a continuous job for good.
    """
    millis = F.col(millis) if isinstance(millis, str) else millis
    fits = millis.between(-_MAX_MILLIS, _MAX_MILLIS)
    return F.when(fits, F.timestamp_millis(millis))


def notional(price: str, volume: str) -> Column:
    """Traded value of one tick; null when either side is null."""
    return F.col(price) * F.col(volume)


def floor_double(value: Column) -> Column:
    """``floor`` that stays a double.

    Spark's ``floor`` of a double is a BIGINT, which would clip large sums and
    turn NaN into 0, so whole and non-finite values pass through unchanged.
    """
    value = value.cast("double")
    return F.when(F.abs(value) < _WHOLE_FROM, F.floor(value).cast("double")).otherwise(value)


def wall_clock(instant: Column) -> Column:
    """Zone-less time of an instant in the session zone."""
    return instant.cast("timestamp_ntz")


def date_keys(time: Column | str) -> list[Column]:
    """Zero-padded string partition keys ``year``, ``month`` and ``day``."""
    return [
        F.date_format(time, "yyyy").alias("year"),
        F.date_format(time, "MM").alias("month"),
        F.date_format(time, "dd").alias("day"),
    ]
