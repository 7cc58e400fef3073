"""From landed exchange responses to tick messages, for tables and streams.

A message keeps all fields of what the exchange sent, also those that no schema
declares; only ``name`` is set. What is no JSON object is skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickflow.functions.codec import close_object, open_objects, text_field
from tickflow.operators.markets import attach_name, common_markets, join_quotes
from tickflow.schemas import POLLED, PUSHED


def polled_messages(markets: DataFrame, payloads: DataFrame, **limits) -> DataFrame:
    """``market``, ``name`` and the message ``value`` of the first quote of each payload,
    for listed markets, with the listed name.

    ``markets`` is ``(market, name)``. A repeated payload is a repeated message:
    the polled exchange is sampled, and every sample counts.
    """
    quotes = open_objects(payloads, first=True)
    quotes = quotes.withColumn("market", text_field("fields", POLLED.market))
    return _messages(join_quotes(markets, quotes, **limits))


def shared_names(pushed: DataFrame, polled: DataFrame, **limits) -> DataFrame:
    """``(market, name)`` of the pushing exchange for markets that both list."""
    return common_markets(pushed, polled, **limits)


def pushed_messages(frames: DataFrame, names: DataFrame, **limits) -> DataFrame:
    """``market``, ``name`` and the message ``value`` of pushed frames; the name is null
    for a market without one."""
    ticks = open_objects(frames, first=False)
    ticks = ticks.withColumn("market", text_field("fields", PUSHED.market))
    return _messages(attach_name(ticks, names, **limits))


def _messages(named: DataFrame) -> DataFrame:
    return named.select("market", "name", close_object("fields", "name", F.col("name")).alias("value"))
