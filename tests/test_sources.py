from __future__ import annotations

import json
import os
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException

from helpers import rows
from tickflow.scratch import ensure_checkpoint_dir, new_folder, remove_folders, shared_root
from tickflow.session import SEOUL, STATE_PROVIDER, STATE_STORE, tick_session
from tickflow.sinks.messages import publish_to_folder, stream_to_folder
from tickflow.sources.payloads import newest_payload, read_markets
from tickflow.sources.ticks import kafka_messages, kafka_options, landed_messages, stored_messages


def test_topic_options():
    assert kafka_options("host:9092", "ticks", "group-a") == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "ticks",
        "startingOffsets": "latest",
        "kafka.group.id": "group-a",
    }
    more = kafka_options("h:1", "t", max_offsets=1000, min_partitions=64)
    assert more["maxOffsetsPerTrigger"] == "1000" and more["minPartitions"] == "64"
    assert "kafka.group.id" not in more
    one = kafka_options("h:1", "t", partition=2)
    assert one["assign"] == '{"t": [2]}' and "subscribe" not in one


def test_topic_needs_the_connector(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        kafka_messages(spark, kafka_options("localhost:1", "t"))


def test_landing_folder_roundtrip(spark, tmp_path):
    folder = str(tmp_path / "land")
    frame = spark.createDataFrame([(1, "비트", None), (2, "b", 1.5)], "n int, name string, p double")
    publish_to_folder(frame, folder)
    publish_to_folder(frame.where("n = 1"), folder, ["n"])
    got = [json.loads(r.value) for r in stored_messages(spark, folder).collect()]
    assert sorted(got, key=str) == sorted(
        [{"n": 1, "name": "비트", "p": None}, {"n": 2, "name": "b", "p": 1.5}, {"n": 1}], key=str
    )


def test_session_settings_leave_the_caller_alone(spark):
    session = tick_session(spark, shuffle_partitions=3)
    assert session.conf.get("spark.sql.session.timeZone") == SEOUL
    assert session.conf.get("spark.sql.shuffle.partitions") == "3"
    assert session.conf.get(STATE_PROVIDER) == STATE_STORE
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_scratch_is_the_folder_the_cluster_names(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root
    one, two = new_folder(spark, "x"), new_folder(spark, "x")
    assert one != two and one.startswith(root)
    ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() is not None


class Session:
    """A session without the setting, on the given master."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = SimpleNamespace(master=master)


def test_only_a_local_session_may_use_a_temporary_folder():
    root = shared_root(Session("local[4]"))
    assert os.path.isdir(root) and shared_root(Session("local[*]")) == root
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session("yarn"))



def _values(spark, folder):
    return sorted(r.value for r in stored_messages(spark, folder).collect())


def test_landing_folder_takes_batch_and_continuous_writes(spark, tmp_path):
    source, folder, once = str(tmp_path / "in"), str(tmp_path / "land"), {"availableNow": True}
    numbers = lambda a, b: spark.range(a, b).selectExpr("cast(id as string) as value")
    numbers(0, 3).write.text(source)

    def stream(checkpoint):
        messages = landed_messages(spark, source)
        stream_to_folder(messages, folder, str(tmp_path / checkpoint), trigger=once, text="value").awaitTermination()

    stream("one")
    publish_to_folder(numbers(3, 8), folder, text="value")
    assert _values(spark, folder) == [str(n) for n in range(8)]
    stream("one")  # nothing new
    assert len(_values(spark, folder)) == 8
    stream("two")  # a new checkpoint sends again
    assert len(_values(spark, folder)) == 11
    for _ in range(2):  # the same batch again
        publish_to_folder(numbers(20, 22), folder, text="value", batch="again")
    assert len(_values(spark, folder)) == 13


def test_newest_listing_is_found_without_opening_others(spark, tmp_path):
    folder = tmp_path / "listing"
    folder.mkdir()
    for name, second in (("a", 5), ("b", 9), ("c", 9), ("d", 7)):
        path = folder / f"{name}.json"
        path.write_text(f'[{{"market": "KRW-{name}", "korean_name": "{name}"}}]')
        os.utime(path, (second, second))
    assert rows(read_markets(spark, str(folder))) == {("KRW-c", "c"): 1}
    plan = newest_payload(spark, str(folder)).inputFiles()
    assert len(plan) == 1


def test_folders_are_removed(spark, tmp_path):
    folder = new_folder(spark, "x")
    spark.range(3).write.parquet(folder)
    assert os.path.isdir(folder)
    remove_folders(spark)
    assert not os.path.exists(folder)
