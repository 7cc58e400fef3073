"""Tick messages: one string column ``value``, from a topic or a landing folder."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickflow.schemas import struct
from tickflow.sinks.steps import complete

KAFKA = "kafka"


def kafka_options(
    servers: str,
    topic: str,
    group: str | None = None,
    starting: str = "latest",
    max_offsets: int | None = None,
    min_partitions: int | None = None,
    partition: int | None = None,
) -> dict[str, str]:
    """Options of the topic scan, or of the scan of one ``partition`` of the topic.

    ``max_offsets`` bounds one micro-batch. ``min_partitions`` reads a crowded
    topic partition with several tasks; nothing downstream needs its order.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "startingOffsets": starting,
    }
    if partition is None:
        options["subscribe"] = topic
    else:
        options["assign"] = json.dumps({topic: [partition]})
    if group is not None:
        options["kafka.group.id"] = group
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_messages(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Unbounded messages of a topic. Needs Spark's Kafka connector on the class path."""
    stream = spark.readStream.format(KAFKA).options(**options).load()
    return stream.selectExpr("CAST(value AS STRING) AS value")


def topic_partitions(spark: SparkSession, servers: str, topic: str) -> int:
    """How many partitions a topic has now, from its brokers. Needs the Kafka connector."""
    jvm = spark._jvm
    settings = jvm.java.util.HashMap()
    settings.put("bootstrap.servers", servers)
    admin = jvm.org.apache.kafka.clients.admin.AdminClient.create(settings)
    try:
        names = jvm.java.util.Collections.singletonList(topic)
        return admin.describeTopics(names).allTopicNames().get().get(topic).partitions().size()
    finally:
        admin.close()


# So many files to leave out are named in the filter, which Spark then applies to the listing.
_NAMED_FILES = 5_000
_PATHS = struct("path string")


def files_at_first_start(spark: SparkSession, folder: str, checkpoint: str) -> DataFrame:
    """The files that were in a landing folder when a query with this checkpoint was first
    started (``path``). They are noted beside the checkpoint then; a checkpoint that was used
    before without a note leaves nothing out."""
    note = f"{checkpoint.rstrip('/')}-first-files"
    if not complete(spark, note):
        used = complete(spark, checkpoint, marker="metadata")
        there = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        found = there.select(F.col("_metadata.file_path").alias("path"))
        (found.where("false") if used else found).write.mode("overwrite").parquet(note)
    return spark.read.schema(_PATHS).parquet(note)


def landed_messages(
    spark: SparkSession, folder: str, max_files: int | None = None, latest_for: str | None = None
) -> DataFrame:
    """Unbounded messages from text files that land in a folder or below it, one per line.

    With ``latest_for``, the checkpoint of the query that will read them, files that are
    there when it is first started do not count, as with a topic's latest offsets."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if latest_for is None:
        return reader.text(folder)
    first = files_at_first_start(spark, folder, latest_for)
    messages = reader.text(folder).select("value", F.col("_metadata.file_path").alias("path"))
    few = [r.path for r in first.limit(_NAMED_FILES + 1).collect()]
    if len(few) <= _NAMED_FILES:
        # Files that the filter names are never opened.
        messages = messages.where(~F.col("path").isin(few)) if few else messages
    else:
        messages = messages.join(first, "path", "left_anti")
    return messages.select("value")


def stored_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The same files as a bounded table."""
    return spark.read.option("recursiveFileLookup", "true").text(folder)
