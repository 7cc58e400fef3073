"""Small builders for messages and landing folders."""

from __future__ import annotations

import json
import os
from collections import Counter

# The only literal data there is: one sample listing and one sample quote.
SAMPLE_LISTING = [{"market": "KRW-BTC", "korean_name": "비트코인", "english_name": "Bitcoin"}]
SAMPLE_QUOTE = {
    "market": "KRW-BTC",
    "trade_date": "20250510",
    "trade_time": "051423",
    "trade_date_kst": "20250510",
    "trade_time_kst": "141423",
    "trade_timestamp": 1746886463399,
    "opening_price": 144520000,
    "trade_price": 144210000,
    "change": "FALL",
    "signed_change_rate": -0.0021,
    "trade_volume": 4.204e-05,
    "highest_52_week_date": "2025-01-21",
    "timestamp": 1746854065313,
}

# 2025-05-10 14:14:00 in Seoul.
MINUTE = 1746854040000


def tick(market, price, volume=1.0, at=0, name=None, **more):
    """A message of the polled exchange, ``at`` milliseconds after MINUTE."""
    return {
        "market": market,
        "name": name or f"name of {market}",
        "trade_price": price,
        "trade_volume": volume,
        "timestamp": MINUTE + at,
        **more,
    }


def lines(messages):
    return [m if isinstance(m, str) else json.dumps(m, ensure_ascii=False) for m in messages]


def table_of(spark, messages):
    return spark.createDataFrame([(line,) for line in lines(messages)], "value string")


def land(folder, number, messages):
    """Put one file into a landing folder; files are read in the order of ``number``."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{number:05d}.json")
    with open(path, "w", encoding="utf-8") as out:
        out.write("".join(line + "\n" for line in lines(messages)))
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def rows(frame, *columns):
    """The rows as a multiset of tuples."""
    chosen = frame.select(*columns) if columns else frame
    return Counter(tuple(row) for row in chosen.collect())


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    assert rows(left, *columns) == rows(right, *columns)
