"""The shared folder for checkpoints and intermediate tables.

Executors can be lost at any time, so intermediate data never goes to a folder
that only one machine can see.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tickflow-")


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where it is not set, a temporary folder serves a local session; on a cluster
    that would be visible to one machine only, so there it is an error.
    """
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{SETTING} must name a folder that every executor can reach")
    return _local_root()


_made: set[str] = set()


def new_folder(spark: SparkSession, purpose: str) -> str:
    """An unused path below the shared folder."""
    folder = f"{shared_root(spark)}/tickflow/{purpose}-{uuid.uuid4().hex}"
    _made.add(folder)
    return folder


_tables: set[str] = set()


def note_table(name: str) -> str:
    """The name of a table of the catalog whose files are in one of the folders."""
    _tables.add(name)
    return name


def remove_folders(spark: SparkSession) -> None:
    """Remove all folders that ``new_folder`` named and something was written to, and the
    catalog's entries of tables in them. Call it when the frames that read them are done
    with."""
    for name in sorted(_tables):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    _tables.clear()
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    for folder in sorted(_made):
        path = path_of(folder)
        path.getFileSystem(conf).delete(path, True)
    _made.clear()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable in this session."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
