"""JSON messages without a key, to a topic or a landing folder.

A landing folder has one sub-folder per write, a micro-batch's named after its query
and number. A micro-batch that is run again finds its sub-folder complete and leaves it,
so readers that have seen its files meet no copies; an incomplete one is replaced.
Batch and continuous writes may share a folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from tickflow.functions.codec import encode_json
from tickflow.session import QUERY_ID
from tickflow.sinks.steps import complete
from tickflow.sources.ticks import KAFKA

Publish = Callable[[DataFrame, str], None]


def batch_name(frame: DataFrame, batch_id: int) -> str:
    """The name of a micro-batch. The id stays with the checkpoint: a query that starts
    over with a new one does not replace what the old one wrote."""
    query = frame.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
    if query is None:
        raise RuntimeError("micro-batch without a query id: its output cannot be named")
    return f"{query}-{batch_id:012d}"


def _texts(rows: DataFrame, columns: Iterable[str] | None, text: str | None) -> DataFrame:
    if text is not None:
        return rows.select(rows[text].alias("value"))
    return encode_json(rows, columns)


def publish_to_topic(
    rows: DataFrame,
    servers: str,
    topic: str,
    columns: Iterable[str] | None = None,
    text: str | None = None,
) -> None:
    """Send a bounded set of rows to a topic. Needs Spark's Kafka connector."""
    (
        _texts(rows, columns, text)
        .write.format(KAFKA)
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def publish_to_folder(
    rows: DataFrame,
    folder: str,
    columns: Iterable[str] | None = None,
    text: str | None = None,
    batch: str | None = None,
    at_once: bool = False,
) -> None:
    """Add a bounded set of rows to a landing folder, one message per line.

    ``text`` names a column that holds the messages already. A ``batch`` that was written
    before is left as it is; without a name every call is a batch of its own. With
    ``at_once`` all of its files appear together, by one rename: readers skip it until then.
    """
    spark = rows.sparkSession
    name = batch or uuid.uuid4().hex
    target = f"{folder}/batch={name}"
    if complete(spark, target):
        return
    texts = _texts(rows, columns, text).write.mode("overwrite")
    if not at_once:
        texts.text(target)
        return
    texts.text(f"{folder}/_batch={name}")
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    waiting, done = path_of(f"{folder}/_batch={name}"), path_of(target)
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).rename(waiting, done):
        raise RuntimeError(f"{folder}: could not put batch {name} in its place")


def follow(stream: DataFrame, publish: Publish, checkpoint: str, trigger: dict | None = None):
    """Call ``publish(rows, name)`` for every micro-batch; returns the started query."""

    def one(rows: DataFrame, batch_id: int) -> None:
        publish(rows, batch_name(rows, batch_id))

    return (
        stream.writeStream.foreachBatch(one)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def stream_to_folder(
    rows: DataFrame,
    folder: str,
    checkpoint: str,
    columns: Iterable[str] | None = None,
    trigger: dict | None = None,
    text: str | None = None,
):
    """Add an unbounded set of rows to a landing folder; returns the started query."""
    return follow(
        rows, lambda batch, name: publish_to_folder(batch, folder, columns, text, name), checkpoint, trigger
    )


def stream_to_topic(
    rows: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    columns: Iterable[str] | None = None,
    trigger: dict | None = None,
    text: str | None = None,
):
    """Send an unbounded set of rows to a topic; returns the started query. A micro-batch
    that is run again is sent again."""
    return follow(
        rows, lambda batch, _: publish_to_topic(batch, servers, topic, columns, text), checkpoint, trigger
    )
