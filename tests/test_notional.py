from __future__ import annotations

from datetime import datetime

import pytest

from pyspark.sql import functions as F

from helpers import MINUTE, SAMPLE_QUOTE, rows, table_of, tick
from tickflow.config import exchange_a, exchange_b
from tickflow.operators.notional import undated, window_start, windowed_notional
from tickflow.plans.ticks import decode_ticks, notional_per_window, top_markets
from tickflow.schemas import POLLED


def per_window(spark, messages):
    return notional_per_window(table_of(spark, messages), exchange_a("", ""))


def test_sample_quote_to_result(seoul):
    sample = {**SAMPLE_QUOTE, "name": "비트코인"}
    result = top_markets(table_of(seoul, [sample]), exchange_a("", ""))
    assert [tuple(r) for r in result.collect()] == [
        (
            "비트코인",
            "KRW-BTC",
            datetime(2025, 5, 10, 14, 14),
            datetime(2025, 5, 10, 14, 15),
            6062.0,
            1,
            "2025",
            "05",
            "10",
        )
    ]
    assert [f.dataType.simpleString() for f in result.schema] == [
        "string", "string", "timestamp_ntz", "timestamp_ntz", "double", "bigint",
        "string", "string", "string",
    ]


def test_repeated_snapshot_counts_twice(seoul):
    frame = per_window(seoul, [tick("KRW-A", 10)] * 2)
    assert rows(frame, "market", "one_m_trade_volume") == {("KRW-A", 20.0): 1}


def test_sum_is_floored_once(seoul):
    frame = per_window(seoul, [tick("KRW-A", 0.75), tick("KRW-A", 0.75)])
    assert frame.first().one_m_trade_volume == 1.0


def test_null_products_are_skipped(seoul):
    messages = [
        tick("KRW-A", 5), tick("KRW-A", None), tick("KRW-A", 7, volume=None),
        tick("KRW-B", None),
    ]
    frame = per_window(seoul, messages)
    assert rows(frame, "market", "one_m_trade_volume") == {("KRW-A", 5.0): 1, ("KRW-B", None): 1}


def test_null_name_and_changed_name_are_groups(seoul):
    base = tick("KRW-A", 1)
    messages = [base, {**base, "name": None}, {**base, "name": None}, {**base, "name": "new"}]
    frame = per_window(seoul, messages)
    assert rows(frame, "name", "one_m_trade_volume") == {
        ("name of KRW-A", 1.0): 1,
        (None, 2.0): 1,
        ("new", 1.0): 1,
    }


def test_window_bounds(seoul):
    frame = per_window(seoul, [tick("KRW-A", 1, at=59_999), tick("KRW-A", 2, at=60_000)])
    assert rows(frame, "window_start", "window_end", "one_m_trade_volume") == {
        (datetime(2025, 5, 10, 14, 14), datetime(2025, 5, 10, 14, 15), 1.0): 1,
        (datetime(2025, 5, 10, 14, 15), datetime(2025, 5, 10, 14, 16), 2.0): 1,
    }


def test_midnight_starts_the_next_seoul_day(seoul):
    midnight = 1746889200000  # 2025-05-10 15:00 UTC
    messages = [
        {**tick("KRW-A", 1), "timestamp": midnight - 1},
        {**tick("KRW-A", 1), "timestamp": midnight},
    ]
    result = top_markets(table_of(seoul, messages), exchange_a("", ""))
    assert rows(result, "year", "month", "day") == {
        ("2025", "05", "10"): 1,
        ("2025", "05", "11"): 1,
    }


def test_event_time_is_not_the_trade_time(seoul):
    shifted = {**tick("KRW-A", 1), "trade_timestamp": MINUTE + 9 * 3600 * 1000}
    assert per_window(seoul, [shifted]).first().window_start == datetime(2025, 5, 10, 14, 14)


def test_undated_ticks_are_set_apart(seoul):
    messages = [tick("KRW-A", 1), {"market": "KRW-B", "trade_price": 1}, {"timestamp": 2**63 - 1}]
    ticks = decode_ticks(table_of(seoul, messages), POLLED)
    assert undated(ticks).count() == 2
    assert windowed_notional(ticks).count() == 1


def test_pushed_messages_use_code(seoul):
    message = {**tick("x", 3), "code": "KRW-A"}
    del message["market"]
    result = top_markets(table_of(seoul, [message]), exchange_b("", ""))
    assert rows(result, "market", "one_m_trade_volume") == {("KRW-A", 3.0): 1}


def test_zoneless_times_do_not_depend_on_the_session_zone(seoul):
    frame = seoul.createDataFrame(
        [("a", datetime(2024, 1, 1, 23, 59, 59), 2.0, 3.0)],
        "market string, t timestamp_ntz, p double, v double",
    )
    day = windowed_notional(frame, "t", "p", "v", [F.col("market")], "1 day").first()
    assert (day.window_start, day.window_end) == (datetime(2024, 1, 1), datetime(2024, 1, 2))


def test_long_windows_follow_the_session_zone(spark):
    assert window_start("1 minute", "Asia/Seoul") == "0 seconds"
    assert window_start("1 day", "Asia/Seoul") == f"{15 * 3600} seconds"
    assert window_start("1 day", "UTC") == "0 seconds"
    assert window_start("1 hour", "Europe/Berlin") == "0 seconds"
    for duration in ("1 day", "2 hours"):
        with pytest.raises(ValueError, match="offset"):
            window_start(duration, "Europe/Berlin")
    with pytest.raises(ValueError, match="duration"):
        window_start("a while", "UTC")
