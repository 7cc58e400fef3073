"""From tick messages to the ranked result; the same steps for tables and streams."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame

from tickflow.config import JobConfig
from tickflow.functions.accounting import Account
from tickflow.functions.codec import decode_json
from tickflow.operators.notional import window_clock, window_groups, with_event_time
from tickflow.operators.rank import top_n, top_n_of_stream
from tickflow.schemas import TickFormat
from tickflow.sinks.published import publish_result, result_columns


def decode_ticks(
    messages: DataFrame,
    format: TickFormat,
    all_columns: bool = False,
    keep: Iterable[str] = (),
    account: Account | None = None,
) -> DataFrame:
    """Ticks with their event time and the market code as ``market``.

    Only the columns the result needs are decoded unless ``all_columns`` is set; ``keep``
    carries other columns of ``messages`` along; ``account`` counts what is left out.
    """
    columns = None if all_columns else format.needed
    ticks = decode_json(messages, format.schema, columns, keep=keep, account=account)
    return with_event_time(ticks).withColumnRenamed(format.market, "market")


def tick_accounts(messages: DataFrame | list[DataFrame], config: JobConfig) -> list[Account]:
    """An account for each of the messages' streams, or for the table."""
    number = 1 if isinstance(messages, DataFrame) else len(messages)
    return [Account(f"{config.name}-{i}", time="timestamp") for i in range(number)]


def groups_per_window(
    messages: DataFrame | list[DataFrame], config: JobConfig, accounts: list[Account] | None = None
) -> DataFrame:
    """Notional per market and ``window`` of a table or a stream of messages.

    Several streams, e.g. one per topic partition, each have their own watermark, and
    a window closes when the slowest of them has passed it. ``accounts``, one for each of
    them, count what the decoder leaves out.
    """
    parts = [messages] if isinstance(messages, DataFrame) else messages
    accounts = accounts or [None] * len(parts)
    ticks = [decode_ticks(part, config.format, account=a) for part, a in zip(parts, accounts, strict=True)]
    timed = [t.withWatermark("event_time", config.delay) if t.isStreaming else t for t in ticks]
    return window_groups(
        reduce(DataFrame.unionByName, timed), duration=config.duration, exact=config.exact
    )


def notional_per_window(
    messages: DataFrame | list[DataFrame], config: JobConfig, accounts: list[Account] | None = None
) -> DataFrame:
    """``groups_per_window`` with zone-less window bounds."""
    return window_clock(groups_per_window(messages, config, accounts))


def top_markets_of_stream(
    messages: DataFrame | list[DataFrame], config: JobConfig, salts: Iterable[int] = (16,)
) -> DataFrame:
    """The result as a stream of its own, for any sink (see ``top_n_of_stream``)."""
    top = top_n_of_stream(groups_per_window(messages, config), config.top, salts=salts)
    return result_columns(window_clock(top))


def top_markets(
    messages: DataFrame, config: JobConfig, accounts: list[Account] | None = None
) -> DataFrame:
    """The result for a bounded table of messages."""
    return result_columns(top_n(notional_per_window(messages, config, accounts), config.top))


def backfill(messages: DataFrame, config: JobConfig, batch: str) -> dict[str, int]:
    """Publish the result of stored messages in one batch job, with markers; gives the counts
    of what was decoded and what was left out.

    Running it again under the same ``batch`` name replaces its earlier output.
    """
    config.check(messages.sparkSession)
    accounts = tick_accounts(messages, config)
    publish_result(top_markets(messages, config, accounts), config.output, batch, rerun=True)
    return accounts[0].counts()
