"""Market listings and quotes: filters, joins and last-wins deduplication."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from tickflow.operators.lookup import lookup_join

# Fixed value: markets quoted in won carry this prefix.
KRW_PREFIX = "KRW-"


def krw_markets(
    listing: DataFrame,
    market: str = "market",
    name: str = "korean_name",
    prefix: str = KRW_PREFIX,
    keep: Iterable[str] = (),
) -> DataFrame:
    """``(market, name)`` of the markets whose code starts with ``prefix``."""
    return listing.where(F.startswith(F.col(market), F.lit(prefix))).select(
        F.col(market).alias("market"), F.col(name).alias("name"), *keep
    )


def last_by_key(rows: DataFrame, key: str, order: Iterable[str]) -> DataFrame:
    """The row of each key that is last in ``order``; later ones replace earlier.

    ``max_by`` is combined before the shuffle, so a key that holds most of the rows
    sends one row per task.
    """
    whole = F.struct(*rows.columns)
    last = F.max_by(whole, F.struct(*order)).alias("_last")
    return rows.groupBy(key).agg(last).select("_last.*")


def common_markets(listing: DataFrame, other: DataFrame, key: str = "market", **limits) -> DataFrame:
    """Rows of ``listing`` whose key is also listed in ``other``; its own names stay."""
    return lookup_join(listing, other.select(key).distinct(), key, "left_semi", **limits)


def attach_name(
    ticks: DataFrame, names: DataFrame, code: str = "market", **limits
) -> DataFrame:
    """Add ``name`` by market code to a table or a stream; null where unknown.

    ``names`` has ``(market, name)``, one row per market.
    """
    by_code = names.select(F.col("market").alias(code), F.col("name"))
    return lookup_join(ticks.drop("name"), by_code, code, "left", **limits)


def join_quotes(listing: DataFrame, quotes: DataFrame, **limits) -> DataFrame:
    """The quotes of listed markets with the listed name; ``listing`` is
    ``(market, name)``, one row per market."""
    return lookup_join(quotes.drop("name"), listing.select("market", "name"), "market", "inner", **limits)


def missing_quotes(listing: DataFrame, quotes: DataFrame, **limits) -> DataFrame:
    """Listed markets that have no quote. They are reported, not fatal."""
    return lookup_join(listing, quotes.select("market").distinct(), "market", "left_anti", **limits)
