"""Session settings that the results depend on, and those that help at scale."""

from __future__ import annotations

from pyspark.sql import SparkSession

SEOUL = "Asia/Seoul"

# Names that Spark gives its settings and properties, used here and in tests.
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
RECENT_UPDATES = "spark.sql.streaming.numRecentProgressUpdates"
QUERY_ID = "sql.streaming.queryId"

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

BATCH_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

TICK_SETTINGS = {
    # A plan that turns out to be empty keeps what it has counted (``functions.accounting``).
    "spark.sql.adaptive.optimizer.excludedRules":
        "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation",
    # Facts of any size are tested with a Bloom filter of a filtered lookup side before they
    # are shuffled. 8 MB of bits: of eight million keys, two in a hundred others pass.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "8000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "8000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "67108864",
}

STREAM_SETTINGS = {
    # State lives on the executors' disks, not on the heap. Only changes are uploaded
    # at each commit, and all state partitions of an executor share one memory limit.
    STATE_PROVIDER: STATE_STORE,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # Of several streams the slowest decides which windows are closed.
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
}


def tick_session(
    spark: SparkSession, zone: str = SEOUL, shuffle_partitions: int | None = None
) -> SparkSession:
    """A new session on the same cluster, with the zone the window bounds and the
    year/month/day keys are derived in. The caller's session is left alone."""
    session = spark.newSession()
    for key, value in {**BATCH_SETTINGS, **TICK_SETTINGS, **STREAM_SETTINGS}.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.session.timeZone", zone)
    partitions = shuffle_partitions or spark.conf.get("spark.sql.shuffle.partitions")
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return session
