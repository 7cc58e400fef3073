"""Traded notional per market and tumbling event-time window."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import TimestampNTZType

from tickflow.functions.scalar import event_time, floor_double, notional, wall_clock
from tickflow.operators.exact import exact_floor_sum

VALUE = "one_m_trade_volume"


def with_event_time(ticks: DataFrame, millis: str = "timestamp", time: str = "event_time") -> DataFrame:
    """Add the event time of each tick, from its epoch milliseconds."""
    return ticks.withColumn(time, event_time(millis))


def undated(ticks: DataFrame, time: str = "event_time") -> DataFrame:
    """Ticks without an event time. They belong to no window and are not counted."""
    return ticks.where(F.col(time).isNull())


_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
# Offsets before the first tick ever do not matter.
_YEARS = range(2000, 2051)


def window_start(duration: str, zone: str) -> str:
    """Spark's ``startTime`` for windows that begin with the days of ``zone``.

    Spark counts windows from the epoch in UTC. That is the same where the offset of the
    zone is a multiple of the duration; else windows are moved by the offset, and a zone
    that changes its offset is refused. Weeks begin on Thursdays, as the epoch does.
    """
    length = sum(
        int(number) * _SECONDS[unit]
        for number, unit in re.findall(r"(\d+)\s*(second|minute|hour|day|week)s?\b", duration)
    )
    if not length:
        raise ValueError(f"not a duration of seconds, minutes, hours, days or weeks: {duration!r}")
    place = ZoneInfo(zone)
    days = [datetime(y, m, 1, tzinfo=timezone.utc) for y in _YEARS for m in range(1, 13)]
    offsets = {int((d.astimezone(place).utcoffset() or timedelta()).total_seconds()) for d in days}
    starts = {-offset % length for offset in offsets}
    if len(starts) > 1:
        raise ValueError(f"windows of {duration} have no fixed start in {zone}, whose offset changes")
    return f"{starts.pop()} seconds"


def tick_window(ticks: DataFrame, time: str, duration: str) -> Column:
    """The window of every tick; none without a time."""
    if isinstance(ticks.select(time).schema[0].dataType, TimestampNTZType):
        return F.window(time, duration)
    zone = ticks.sparkSession.conf.get("spark.sql.session.timeZone")
    return F.window(time, duration, startTime=window_start(duration, zone))


def window_groups(
    ticks: DataFrame,
    time: str = "event_time",
    price: str = "trade_price",
    volume: str = "trade_volume",
    keys: Iterable[str | Column] = ("market", "name"),
    duration: str = "1 minute",
    exact: bool = False,
) -> DataFrame:
    """Floor of the summed notional per window and key: the keys, ``window`` and the value.
    Windows are those of the session zone's clock; times without a zone have windows of
    their own clock.

    Works on tables and on streams that have a watermark on ``time``; ``window`` carries it
    on, so further aggregates can follow. Repeated snapshots of a quote all count, null
    products are skipped, and a null key is a group like any other. The sum is combined
    before the shuffle, so what is shuffled grows with the groups, not with the ticks. With
    ``exact`` the result does not depend on the order of addition (see ``operators.exact``);
    a group then has ten numbers in place of one until it is finished.
    """
    window = tick_window(ticks, time, duration).alias("window")
    value = notional(price, volume).cast("double")
    total = exact_floor_sum(value) if exact else floor_double(F.sum(value))
    return ticks.groupBy(*keys, window).agg(total.alias(VALUE))


def window_clock(groups: DataFrame) -> DataFrame:
    """The groups with ``window`` as zone-less ``window_start`` and ``window_end``, before
    the value and what stands behind it."""
    at = groups.columns.index(VALUE)
    before, after = groups.columns[:at], groups.columns[at:]
    return groups.select(
        *[c for c in before if c != "window"],
        wall_clock(F.col("window.start")).alias("window_start"),
        wall_clock(F.col("window.end")).alias("window_end"),
        *[c for c in after if c != "window"],
    )


def windowed_notional(ticks: DataFrame, *args, **options) -> DataFrame:
    """``window_groups`` with the bounds of the windows as zone-less times."""
    return window_clock(window_groups(ticks, *args, **options))
