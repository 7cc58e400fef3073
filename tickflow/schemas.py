"""Declared schemas. Nothing is inferred from data anywhere in the package."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


def struct(columns: str) -> StructType:
    """A schema from ``name type`` pairs; needs no running session, unlike a DDL text."""
    schema = StructType()
    for column in columns.split(","):
        name, kind = column.split()
        schema.add(name, kind)
    return schema


# Field names, order and types of the messages and of the result.

TICKS_A = struct(
    "market string, trade_date string, trade_time string, trade_date_kst string, "
    "trade_time_kst string, trade_timestamp long, opening_price double, "
    "high_price double, low_price double, trade_price double, "
    "prev_closing_price double, change string, change_price double, "
    "change_rate double, signed_change_price double, signed_change_rate double, "
    "trade_volume double, acc_trade_price double, acc_trade_price_24h double, "
    "acc_trade_volume double, acc_trade_volume_24h double, "
    "highest_52_week_price double, highest_52_week_date string, "
    "lowest_52_week_price double, lowest_52_week_date string, "
    "timestamp long, name string"
)

TICKS_B = struct(
    "type string, code string, opening_price double, high_price double, "
    "low_price double, trade_price double, prev_closing_price double, "
    "acc_trade_price double, change string, change_price double, "
    "signed_change_price double, change_rate double, signed_change_rate double, "
    "ask_bid string, trade_volume double, acc_trade_volume double, "
    "trade_date string, trade_time string, trade_timestamp long, "
    "acc_ask_volume double, acc_bid_volume double, highest_52_week_price double, "
    "highest_52_week_date string, lowest_52_week_price double, "
    "lowest_52_week_date string, market_state string, "
    "is_trading_suspended boolean, delisting_date string, market_warning string, "
    "timestamp long, acc_trade_price_24h double, acc_trade_volume_24h double, "
    "stream_type string, name string"
)

LISTING = struct("market string, korean_name string, english_name string")

RESULT = struct(
    "name string, market string, window_start timestamp_ntz, "
    "window_end timestamp_ntz, one_m_trade_volume double, row_num long"
)

PARTITIONS = struct("year string, month string, day string")

# End of fixed values.

# Lowest directory level of the published layout: one per committed write.
BATCH = struct("batch string")

PUBLISHED = StructType(RESULT.fields + PARTITIONS.fields)


@dataclass(frozen=True)
class TickFormat:
    """Which message schema an exchange uses and how it names the market."""

    schema: StructType
    market: str

    @property
    def needed(self) -> list[str]:
        """The columns the result is computed from; the others are never read."""
        return [self.market, "name", "trade_price", "trade_volume", "timestamp"]


POLLED = TickFormat(TICKS_A, "market")
PUSHED = TickFormat(TICKS_B, "code")
