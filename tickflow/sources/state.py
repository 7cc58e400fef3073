"""The state of a continuous job as a table: windows that are still open.

A window is published once, when later ticks have closed it. Until then its groups are in
the job's state only. Spark's state reader gives them as of the last finished micro-batch,
also while the job runs; nothing is written, and the job does not notice.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickflow.config import JobConfig
from tickflow.functions.scalar import floor_double
from tickflow.operators.exact import unfinished
from tickflow.operators.notional import VALUE, window_clock
from tickflow.operators.rank import top_n

_KEYS = {"market", "name", "window"}


def _states(spark: SparkSession, checkpoint: str, batch: int | None) -> DataFrame | None:
    """The state of the aggregate of ticks; a chained job has others behind it."""
    try:
        found = spark.read.format("state-metadata").load(checkpoint)
        # One row per operator of the query.
        operators = [r.operatorId for r in found.select("operatorId").distinct().collect()]
    except PySparkException as error:
        if not (error.getCondition() or "").startswith(("PATH_NOT_FOUND", "STDS_")):
            raise
        operators = []
    if not operators:
        return None
    for operator in sorted(operators):
        reader = spark.read.format("statestore").option("operatorId", operator)
        if batch is not None:
            reader = reader.option("batchId", batch)
        state = reader.load(checkpoint)
        if _KEYS <= set(state.schema["key"].dataType.names):
            return state
    raise ValueError(f"{checkpoint} is not the checkpoint of a tick job")


def _value(state: DataFrame, config: JobConfig) -> Column:
    if config.exact:
        return unfinished("value")
    return floor_double(F.col("value.sum"))


def open_groups(spark: SparkSession, config: JobConfig, batch: int | None = None) -> DataFrame:
    """market, name, window and notional so far of every group that is not published yet.

    ``batch`` names an earlier micro-batch, of those that the checkpoint still has. A job that
    has not finished a micro-batch has no groups."""
    session = config.session(spark)
    state = _states(session, config.checkpoint, batch)
    if state is None:
        schema = f"market string, name string, window_start timestamp_ntz, window_end timestamp_ntz, {VALUE} double"
        return session.createDataFrame([], schema)
    return window_clock(state.select("key.*", _value(state, config).alias(VALUE)))


def open_top(spark: SparkSession, config: JobConfig, batch: int | None = None) -> DataFrame:
    """The ranking of the open windows as it stands."""
    return top_n(open_groups(spark, config, batch), config.top)
