"""Expressions on texts that several operators share; all of them run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The ASCII white space that separates words.
SPACE = "\x20\x09-\x0d"
TRIM = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: Column) -> Column:
    """The words of a text as an array; empty for null."""
    found = F.split(F.btrim(text, F.lit(TRIM)), r"[\x20\x09-\x0D]+")
    return F.filter(F.coalesce(found, F.array().cast("array<string>")), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is.

    ``lower`` also changes letters beyond ASCII, so it serves plain ASCII texts only;
    the others are translated letter by letter, which is slower."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
