"""Random ticks: the result is the one a direct computation gives."""

from __future__ import annotations

import math
from collections import defaultdict

from hypothesis import HealthCheck, given, settings, strategies as st

from helpers import MINUTE, table_of
from tickflow.config import exchange_a
from tickflow.plans.ticks import top_markets

CONFIG = exchange_a("", "")

ticks = st.lists(
    st.fixed_dictionaries(
        {
            "market": st.sampled_from([f"KRW-{c}" for c in "ABCDEFGH"]),
            "name": st.sampled_from(["x", "y", None]),
            "trade_price": st.one_of(st.none(), st.integers(-50, 1000)),
            "trade_volume": st.one_of(st.none(), st.integers(0, 20)),
            "timestamp": st.integers(MINUTE - 90_000, MINUTE + 90_000),
        }
    ),
    max_size=40,
)


def directly(messages):
    """Top five per minute as ``(minute, rank, market, name, value)``."""
    totals = defaultdict(lambda: defaultdict(lambda: None))
    for message in messages:
        group = totals[message["timestamp"] // 60_000]
        key = (message["market"], message["name"])
        product = None
        if message["trade_price"] is not None and message["trade_volume"] is not None:
            product = message["trade_price"] * message["trade_volume"]
        known = group[key]
        group[key] = known if product is None else (known or 0) + product
    for minute, group in totals.items():
        order = sorted(
            group.items(),
            key=lambda e: (e[1] is None, -(e[1] or 0), e[0][0], e[0][1] is not None, e[0][1] or ""),
        )
        for rank, ((market, name), value) in enumerate(order[:5], 1):
            yield (minute, rank, market, name, None if value is None else float(math.floor(value)))


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(messages=ticks, parts=st.integers(1, 4))
def test_result_is_the_direct_one(spark, messages, parts):
    frame = top_markets(table_of(spark, messages or ["x"]).repartition(parts), CONFIG)
    got = frame.selectExpr(
        "unix_seconds(cast(window_start as timestamp)) div 60 as minute",
        "row_num", "market", "name", "one_m_trade_volume",
    )
    assert sorted(map(tuple, got.collect()), key=str) == sorted(directly(messages), key=str)
