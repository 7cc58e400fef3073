"""Published results: JSON lines under ``year=/month=/day=``, one folder per write.

A day is read through its own prefix, so a reader looks at that day's folders and
not at the whole history. Of a day that has a manifest the folders named there are read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tickflow.schemas import BATCH, PARTITIONS, PUBLISHED, RESULT
from tickflow.sinks.manifest import Store
from tickflow.sinks.manifest import day_folder as folder_of
from tickflow.sinks.published import LOCAL_TIME

_LAYOUT = StructType(PUBLISHED.fields + BATCH.fields)


def day_folder(root: str, year: str, month: str, day: str) -> str:
    """The prefix of one day; month and day are zero-padded."""
    return f"{root}/year={year}/month={month}/day={day}"


def today(spark: SparkSession) -> tuple[str, str, str]:
    """Partition keys of the current date in the session zone."""
    row = spark.range(1).select(
        F.date_format(F.current_date(), "yyyy"),
        F.date_format(F.current_date(), "MM"),
        F.date_format(F.current_date(), "dd"),
    ).first()
    return tuple(row)


def read_batches(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    """The published rows of these folders below ``root``."""
    reader = (
        spark.read.schema(_LAYOUT)
        .option("basePath", root)
        .option("timestampNTZFormat", LOCAL_TIME)
    )
    try:
        return reader.json(folders).select(*PUBLISHED.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PUBLISHED)


def _named(folder: str, batches: list[str]) -> list[str]:
    return [f"{folder}/batch={batch}" for batch in batches]


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """All published rows. Filters on year, month and day prune the files read."""
    days = Store(spark, root).manifests()
    if not any(m.number for m in days.values()):
        return read_batches(spark, root, [root])
    folders = []
    for day, manifest in days.items():
        folder = folder_of(root, day)
        folders += _named(folder, manifest.batches) if manifest.number else [folder]
    return read_batches(spark, root, folders) if folders else spark.createDataFrame([], PUBLISHED)


def read_day(spark: SparkSession, root: str, year: str, month: str, day: str) -> DataFrame:
    """The published rows of one day; no rows if nothing was published for it."""
    folder = day_folder(root, year, month, day)
    manifest = Store(spark, root).manifest((year, month, day))
    if not manifest.number:
        return read_batches(spark, root, [folder])
    if not manifest.entries:
        return spark.createDataFrame([], PUBLISHED)
    return read_batches(spark, root, _named(folder, manifest.batches))


def newest_folder(spark: SparkSession, root: str, day: tuple[str, str, str]) -> str | None:
    """The folder of a day's last write; the day's own if it has no manifest, none if
    nothing in it counts."""
    manifest = Store(spark, root).manifest(day)
    if not manifest.number:
        return day_folder(root, *day)
    if not manifest.entries:
        return None
    return _named(day_folder(root, *day), manifest.batches)[-1]


def read_file(spark: SparkSession, path: str) -> DataFrame:
    """The rows of one published file, without partition keys."""
    reader = spark.read.schema(RESULT).option("timestampNTZFormat", LOCAL_TIME)
    return reader.json(path)


def published_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path`` and ``modificationTime`` of the result files below ``folder``.

    Only the listing is used; no file is opened. Marker files are left out.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "modificationTime")
    )


def published_days(spark: SparkSession, root: str) -> DataFrame:
    """The distinct year, month and day that have result files."""
    keys = [
        F.regexp_extract("path", rf"/{name}=([^/]+)/", 1).alias(name) for name in PARTITIONS.names
    ]
    return published_files(spark, root).select(*keys).distinct()
