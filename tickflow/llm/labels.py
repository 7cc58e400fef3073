"""Labelled texts to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Labels up to this number of rows (16 bytes each) are broadcast, so that only labels
# move; more are joined by a shuffle of both sides.
BROADCAST_ROWS = 1_000_000


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Rows kept from learning, by the checksum of their id. Without an id: false."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % parts == part, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, column: str, kept_out: Column) -> tuple[DataFrame, int]:
    """doc_id, text and label of the rows to learn from, and the number of labels.

    Rows without an id or a label teach nothing; of several labels of a document the
    largest counts; repeated documents count each."""
    known = (
        labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & ~kept_out)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col(column).cast("int")).alias("label"))
    )
    n = known.count()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(known) if n <= BROADCAST_ROWS else known, "doc_id"), n


def sample(rows: DataFrame, n: int, most: int) -> DataFrame:
    """About ``most`` of ``n`` rows, chosen by a hash of their id; all if there are fewer."""
    if n <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * most / n))
