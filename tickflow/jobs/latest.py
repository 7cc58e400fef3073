"""The last row of every key of a stream, as a small table that lookups read.

The state holds one row per key. Each micro-batch gives the keys whose last row may have
changed, and they replace those of the version before, so the table is always whole. Readers
take the newest finished version (``sinks.steps``). A micro-batch that is run again starts
from the same version, and a restarted query goes on from its state.

The whole table is written with every micro-batch: it is for listings and the like, whose
keys are few, however many rows come in. The state is worked on by one task for each of its
partitions, and the files of a version are as many as its keys ask for.
"""

from __future__ import annotations

from collections.abc import Iterable
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tickflow.operators.markets import last_by_key
from tickflow.sinks.steps import newest_step, put_step

# About so many rows at most go into one file of a version, each file by a task of its own.
FILE_ROWS = 50_000


def start_latest(
    rows: DataFrame, key: str, order: Iterable[str], root: str, checkpoint: str, trigger: dict | None = None
):
    """Keep the table ``root`` up to date with a stream and return the running query.

    The row of a key that is last in ``order`` counts, in whatever order rows arrive; of rows
    that are equal in it any. A null key is a key like any other. The state grows with the
    keys, not with the rows, and keeps them for good."""
    last = last_by_key(rows, key, order)
    schema = rows.schema

    def upsert(changed: DataFrame, number: int) -> None:
        # Counted and used twice, and worked out once. Gathering it without a shuffle would
        # make one task sort all partitions of the state.
        changed = changed.persist()
        try:
            version, size = changed, changed.count()
            table = newest_step(changed.sparkSession, root, schema, below=number)
            if table is not None:
                size += table.count()
                kept = table.join(changed, table[key].eqNullSafe(changed[key]), "left_anti")
                version = kept.unionByName(changed)
            # Few keys: one file per version.
            put_step(version.repartition(max(1, ceil(size / FILE_ROWS)), key), root, number)
        finally:
            changed.unpersist()

    return (
        last.writeStream.outputMode("update")
        .foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def read_latest(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The table as of the last finished micro-batch; no rows before the first."""
    table = newest_step(spark, root, schema)
    return spark.createDataFrame([], schema) if table is None else table
