"""What a viewer of the published result asks for."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickflow.schemas import RESULT
from tickflow.sources.published import newest_folder, published_files, read_day, read_file, today


def newest_file(
    spark: SparkSession, root: str, day: tuple[str, str, str] | None = None
) -> DataFrame:
    """Rows of the file of a day (default: today) that was written last.

    The day's manifest names the last write; its file is found from the listing alone. No
    rows if the day has none.
    """
    folder = newest_folder(spark, root, day or today(spark))
    if folder is None:
        return spark.createDataFrame([], RESULT)
    newest = F.max(F.struct("modificationTime", "path")).alias("newest")
    try:
        found = published_files(spark, folder).agg(newest).first().newest
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = None
    if found is None:
        return spark.createDataFrame([], RESULT)
    return read_file(spark, found.path)


def newest_window(
    spark: SparkSession, root: str, day: tuple[str, str, str] | None = None
) -> DataFrame:
    """Rows of the newest closed window of a day (default: today), in rank order."""
    rows = read_day(spark, root, *(day or today(spark)))
    # One row, so it is safe to broadcast.
    last = rows.agg(F.max("window_end").alias("window_end"))
    return rows.join(F.broadcast(last), "window_end").select(rows.columns).orderBy("row_num")
