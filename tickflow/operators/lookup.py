"""Equi-joins of many rows (``facts``) with one row per key (``names``).

A listing of markets is small and is broadcast, after its size was measured. A
lookup side that grows with the data is shuffled instead; Spark's skew join then
splits the keys that hold too many fact rows for one task (``BATCH_SETTINGS`` turns
it on). All plans give the same rows.

Where facts without a partner fall away (inner and semi joins), they need not be shuffled.
The range of the lookup's keys is measured with its size and stated as a filter: Catalyst
hands it on to the facts, down to their scan, and, as the lookup side is now a filtered one,
builds a Bloom filter of its keys and tests the facts with that before the exchange
(``TICK_SETTINGS`` say when). Both only drop facts that the join would drop.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StringType

from tickflow.scratch import new_folder

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 << 20


@dataclass(frozen=True)
class Measured:
    """Size of a lookup side, and the range of its keys (null if it has none)."""

    rows: int
    bytes: int
    low: object
    high: object

    def fits(self, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
        """Whether it is small enough for every executor."""
        return self.rows <= max_rows and self.bytes <= max_bytes


def measure(names: DataFrame, key: str) -> Measured:
    """One pass over the lookup side."""
    width = sum(
        (
            F.coalesce(F.octet_length(f.name), F.lit(0))
            if isinstance(f.dataType, (StringType, BinaryType))
            else F.lit(8)
            for f in names.schema.fields
        ),
        F.lit(16),
    )
    found = names.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0)), F.min(key), F.max(key)
    ).first()
    return Measured(*found)


def fits_broadcast(
    names: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether ``names`` is measured to be small enough for every executor."""
    return measure(names, names.columns[0]).fits(max_rows, max_bytes)


def check_unique(names: DataFrame, key: str) -> None:
    """Refuse a lookup side with several rows of a key: it would multiply the facts."""
    twice = names.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    found = twice.where("n > 1").select(key).take(1)
    if found:
        raise ValueError(f"{key} {found[0][0]!r} has several rows on the lookup side")


def lookup_join(
    facts: DataFrame,
    names: DataFrame,
    key: str,
    how: str,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``facts`` with ``names`` on ``key``; ``names`` has one row per key.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``; for the last two a key
    may have several rows. ``names`` is written out once and measured, checked and joined
    from that copy. Keys are ranged and tested if they are whole numbers or texts.
    """
    spark = names.sparkSession
    folder = new_folder(spark, "names")
    names.write.parquet(folder)
    names = spark.read.schema(names.schema).parquet(folder)
    if how in ("inner", "left"):
        check_unique(names, key)
    size = measure(names, key)
    if size.fits(max_rows, max_bytes):
        names = F.broadcast(names)
    elif how in ("inner", "left_semi") and isinstance(size.low, (int, str)):
        names = names.where(F.col(key).between(F.lit(size.low), F.lit(size.high)))
    return facts.join(names, key, how)
