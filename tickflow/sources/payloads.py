"""Landed responses of an exchange: one JSON array per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickflow.functions.codec import decode_listing
from tickflow.operators.markets import krw_markets, last_by_key
from tickflow.schemas import LISTING


def _captured(files: DataFrame) -> DataFrame:
    return files.select(
        "value", F.col("_metadata.file_modification_time").alias("captured_at")
    )


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """``value`` and ``captured_at`` (the file's time) of every payload file."""
    return _captured(spark.read.text(folder, wholetext=True))


def stream_payloads(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """The same for files that keep landing."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _captured(reader.text(folder, wholetext=True))


def newest_payload(spark: SparkSession, folder: str) -> DataFrame:
    """``value`` of the newest payload file, of equally new ones that with the largest path.
    It is found from the listing, so no other file is opened."""
    files = spark.read.format("binaryFile").load(folder).select("path", "modificationTime")
    newest = files.agg(F.max(F.struct("modificationTime", "path")).alias("newest")).first().newest
    if newest is None:
        return spark.createDataFrame([], "value string")
    return spark.read.text(newest.path, wholetext=True)


def read_markets(spark: SparkSession, folder: str) -> DataFrame:
    """``(market, name)`` of the won markets of the newest listing in ``folder``.

    A market that is listed twice has the name that comes last; one that is no longer
    listed is gone.
    """
    rows = decode_listing(newest_payload(spark, folder), LISTING)
    listed = krw_markets(rows, keep=["position"])
    return last_by_key(listed, "market", ["position"]).select("market", "name")
