"""A gate before the job: ticks whose window is closed already go to a side table.

Spark drops late rows inside the aggregate, by a watermark that lags a micro-batch behind,
and leaves a count of groups only. The gate is a continuous query of its own. Of every
micro-batch it notes the newest event time; the watermark of the next one is the newest so
far less the delay, which is what Spark's own would be. A tick whose window ended at or
before it is late: it goes to the side table with that watermark. All others are handed on
as they came to a landing folder, which the job reads in place of the messages.

A micro-batch that is run again has the same watermark and the same rows and finds its
output in place, so nothing is doubled, lost or judged anew. Its messages appear in the
landing folder at once, so the job never takes them apart, and, its watermark being no newer
than the gate's, drops none of them. (The job must not limit the files of a micro-batch.)
Messages that are no JSON objects end here, as they would in the job; ticks without a usable
time pass.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickflow.config import JobConfig
from tickflow.functions.codec import decode_json
from tickflow.operators.notional import tick_window, with_event_time
from tickflow.plans.ticks import decode_ticks
from tickflow.schemas import struct
from tickflow.sinks.messages import batch_name, publish_to_folder
from tickflow.sinks.steps import complete, newest_step, put_step

# Microseconds since the epoch, so no zone comes between.
_NEWEST = struct("newest long")
_LATE = struct(
    "value string, window_start timestamp, window_end timestamp, watermark timestamp, micro_batch long"
)


def on_time_folder(folder: str) -> str:
    """Where the job reads what has passed the gate ``folder``."""
    return f"{folder}/on-time"


def _late_folder(folder: str) -> str:
    return f"{folder}/late"


def _judge(rows: DataFrame, config: JobConfig, folder: str, number: int) -> None:
    """Deal one micro-batch out and note the newest event time so far."""
    spark, name = rows.sparkSession, batch_name(rows, number)
    marks = f"{folder}/marks"
    before = newest_step(spark, marks, _NEWEST, below=number)
    newest = before.first().newest if before else None
    # Null before the first event time: nothing is late.
    watermark = F.timestamp_micros(F.lit(newest).cast("long")) - F.expr(f"INTERVAL {config.delay}")

    ticks = with_event_time(decode_json(rows, config.format.schema, ["timestamp"], keep=["value"]))
    ticks = ticks.select("value", "event_time").persist()
    try:
        window = tick_window(ticks, "event_time", config.duration).alias("window")
        dated = ticks.where("event_time is not null").select("value", window)
        is_late = F.coalesce(F.col("window.end") <= watermark, F.lit(False))
        late = dated.where(is_late).select(
            "value",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            watermark.alias("watermark"),
            F.lit(number).cast("long").alias("micro_batch"),
        )
        target = f"{_late_folder(folder)}/batch={name}"
        if newest is not None and not complete(spark, target):
            late.write.mode("overwrite").parquet(target)
        passed = dated.where(~is_late).select("value").union(ticks.where("event_time is null").select("value"))
        publish_to_folder(passed, on_time_folder(folder), text="value", batch=name, at_once=True)
        latest = ticks.agg(F.unix_micros(F.max("event_time")).alias("newest"))
        latest = latest.select(F.greatest("newest", F.lit(newest).cast("long")).alias("newest"))
        put_step(latest.coalesce(1), marks, number)
    finally:
        ticks.unpersist()


def start_gate(
    messages: DataFrame, config: JobConfig, folder: str, checkpoint: str, trigger: dict | None = None
):
    """Start the gate of a job on a stream of messages and return the running query.

    ``config`` is the job's: its message format, zone, windows and delay count here."""
    config.check_zone(messages.sparkSession)
    return (
        messages.select("value")
        .writeStream.queryName(f"{config.name}-gate")
        .foreachBatch(lambda rows, number: _judge(rows, config, folder, number))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": config.trigger}))
        .start()
    )


def late_ticks(spark: SparkSession, config: JobConfig, folder: str) -> DataFrame:
    """The ticks that came after their window was closed, with its bounds, the watermark that
    they were behind and the number of their micro-batch."""
    session = config.session(spark)
    try:
        reader = session.read.schema(_LATE).option("recursiveFileLookup", "true")
        rows = reader.parquet(_late_folder(folder))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = session.createDataFrame([], _LATE)
    return decode_ticks(rows, config.format, keep=_LATE.names[1:])
