"""Small tables that a continuous query replaces as a whole, micro-batch by micro-batch.

Each micro-batch writes its version into a folder of its own, ``step=NUMBER``; the newest
finished one is the table. A micro-batch that is run again replaces its own folder and takes
the version before it from an older one, so it comes to the same table. Spark marks a
finished write; a reader never takes an unfinished one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Versions that stay, for readers that have just looked up an older one.
KEPT = 3


def _store(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def complete(spark: SparkSession, folder: str, marker: str = "_SUCCESS") -> bool:
    """Whether Spark has finished writing this folder (or has left another marker in it)."""
    path, store = _store(spark, f"{folder}/{marker}")
    return store.exists(path)


def _steps(spark: SparkSession, root: str) -> list[int]:
    """The numbers of all finished versions, ascending."""
    pattern, store = _store(spark, f"{root}/step=*/_SUCCESS")
    found = store.globStatus(pattern) or []
    return sorted(int(str(f.getPath().getParent().getName()).split("=")[1]) for f in found)


def _folder(root: str, number: int) -> str:
    return f"{root}/step={number:012d}"


def newest_step(
    spark: SparkSession, root: str, schema: StructType, below: int | None = None
) -> DataFrame | None:
    """The newest finished version, of those before ``below``; None if there is none."""
    numbers = [n for n in _steps(spark, root) if below is None or n < below]
    return spark.read.schema(schema).parquet(_folder(root, numbers[-1])) if numbers else None


def put_step(version: DataFrame, root: str, number: int) -> None:
    """Write ``version`` as that of micro-batch ``number``; the oldest ones go."""
    spark = version.sparkSession
    version.write.mode("overwrite").parquet(_folder(root, number))
    for old in [n for n in _steps(spark, root) if n < number][: -KEPT + 1]:
        path, store = _store(spark, _folder(root, old))
        store.delete(path, True)
