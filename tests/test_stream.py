from __future__ import annotations

import os
import random
import subprocess
import sys

import pytest

import tickflow.jobs.job as job
from helpers import land, rows, table_of, tick
from tickflow.config import exchange_a, exchange_b
from tickflow.plans.producers import polled_messages, pushed_messages
from tickflow.plans.ticks import notional_per_window, top_markets
from tickflow.sinks.messages import stream_to_folder
from tickflow.session import RECENT_UPDATES, STATE_PROVIDER
from tickflow.sources.payloads import stream_payloads
from tickflow.sources.published import read_published
from tickflow.sources.ticks import landed_messages, stored_messages
from tickflow.sinks.published import marked_days

KEYS = ("name", "market", "window_start", "window_end", "one_m_trade_volume", "row_num")


@pytest.fixture
def place(tmp_path):
    config = exchange_a(str(tmp_path / "out"), str(tmp_path / "check"), shuffle_partitions=4)
    return config, str(tmp_path / "land")


def read_back(session, folder, schema):
    return session.read.option("recursiveFileLookup", "true").json(folder, schema=schema)


def random_minutes(seed, minutes, markets=9, per_minute=40):
    rng = random.Random(seed)
    for minute in range(minutes):
        ticks = [
            tick(
                f"KRW-{rng.randrange(markets)}",
                rng.randrange(1, 50),
                rng.randrange(1, 5),
                at=minute * 60_000 + rng.randrange(60_000),
            )
            for _ in range(per_minute)
        ]
        ticks.sort(key=lambda t: t["timestamp"])
        yield ticks + ["junk", ""]


def closed(spark, folder, config, newest):
    """The batch result, less the windows the watermark has not passed."""
    seconds = (newest - 1000) / 1000
    return top_markets(stored_messages(spark, folder), config).where(
        f"window_end <= cast(timestamp_seconds({seconds}) as timestamp_ntz)"
    )


def newest_time(batches):
    return max(t["timestamp"] for batch in batches for t in batch if isinstance(t, dict))


def test_stream_equals_batch_on_closed_windows(seoul, place):
    config, folder = place
    batches = list(random_minutes(1, 6))
    for number, batch in enumerate(batches):
        land(folder, number, batch)
    query = job.run_available(landed_messages(seoul, folder, max_files=1), config)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 6
    want = closed(seoul, folder, config, newest_time(batches))
    published = read_published(seoul, config.output)
    assert published.count() == 25
    assert rows(published, *KEYS) == rows(want, *KEYS)
    assert rows(marked_days(seoul, config.output)) == {("2025", "05", "10"): 1}
    metrics = query.recentProgress[0]["stateOperators"][0]["customMetrics"]
    assert any(name.startswith("rocksdb") for name in metrics)


def test_restart_on_the_same_checkpoint(seoul, place):
    config, folder = place
    batches = list(random_minutes(2, 7))
    for number, batch in enumerate(batches):
        land(folder, number, batch)
        if number in (2, 3, 6):
            job.run_available(landed_messages(seoul, folder, max_files=1), config)
    before = rows(read_published(seoul, config.output), *KEYS)
    job.run_available(landed_messages(seoul, folder, max_files=1), config)
    assert rows(read_published(seoul, config.output), *KEYS) == before
    assert before == rows(closed(seoul, folder, config, newest_time(batches)), *KEYS)


@pytest.mark.parametrize("stage", ["before", "written"])
def test_failed_micro_batch_is_repeated_without_loss_or_copies(seoul, place, monkeypatch, stage):
    config, folder = place
    batches = list(random_minutes(3, 5))
    for number, batch in enumerate(batches):
        land(folder, number, batch)
    publish, calls = job.publish_result, []

    def failing(result, root, batch):
        calls.append(batch)
        if stage == "written":
            publish(result, root, batch)
        if len(calls) == 3:
            raise RuntimeError("lost on purpose")
        if stage == "before":
            publish(result, root, batch)

    monkeypatch.setattr(job, "publish_result", failing)
    with pytest.raises(Exception, match="lost on purpose"):
        job.run_available(landed_messages(seoul, folder, max_files=1), config)
    job.run_available(landed_messages(seoul, folder, max_files=1), config)
    assert calls[2] in calls[3:]
    want = closed(seoul, folder, config, newest_time(batches))
    assert rows(read_published(seoul, config.output), *KEYS) == rows(want, *KEYS)


def test_new_checkpoint_does_not_replace_published_rows(seoul, place, tmp_path):
    config, folder = place
    land(folder, 0, [tick("KRW-A", 1), tick("KRW-A", 1, at=120_000)])
    job.run_available(landed_messages(seoul, folder), config)
    other = exchange_a(config.output, str(tmp_path / "check2"), shuffle_partitions=4)
    job.run_available(landed_messages(seoul, folder), other)
    assert read_published(seoul, config.output).count() == 2


def test_late_rows_are_dropped_and_counted(seoul, place):
    config, folder = place
    land(folder, 0, [tick("KRW-A", 1)])
    land(folder, 1, [tick("KRW-A", 1, at=200_000)])
    land(folder, 2, [tick("KRW-A", 1, at=201_000)])
    land(folder, 3, [tick("KRW-A", 100, at=10_000), tick("KRW-A", 1, at=300_000)])
    query = job.run_available(landed_messages(seoul, folder, max_files=1), config)
    assert job.late_groups(query) == 1
    published = rows(read_published(seoul, config.output), "window_start", "one_m_trade_volume")
    assert sorted(value for _, value in published) == [1.0, 2.0]


def test_late_groups_are_counted_over_the_whole_run(seoul, place):
    config, folder = place
    seoul.conf.set(RECENT_UPDATES, "5")
    try:
        land(folder, 0, [tick("KRW-A", 1)])
        land(folder, 1, [tick("KRW-A", 1, at=200_000)])
        for number in range(2, 14):
            land(folder, number, [tick("KRW-A", 1, at=1000), tick("KRW-A", 1, at=200_000 + number)])
        query = job.run_available(landed_messages(seoul, folder, max_files=1), config)
    finally:
        seoul.conf.unset(RECENT_UPDATES)
    assert len(query.recentProgress) <= 5
    assert job.late_groups(query) == 12 - 1  # the first of them came before the watermark moved


def test_state_on_the_heap_is_refused(seoul, place):
    config, folder = place
    other = config.session(seoul)
    other.conf.unset(STATE_PROVIDER)
    with pytest.raises(ValueError, match="state"):
        config.check(other)


def test_rows_within_the_delay_count(seoul, tmp_path):
    config = exchange_a(
        str(tmp_path / "out"), str(tmp_path / "check"), delay="30 seconds", shuffle_partitions=4
    )
    folder = str(tmp_path / "land")
    land(folder, 0, [tick("KRW-A", 1, at=59_000)])
    land(folder, 1, [tick("KRW-A", 1, at=80_000)])
    land(folder, 2, [tick("KRW-A", 1, at=81_000)])
    land(folder, 3, [tick("KRW-A", 5, at=55_000)])
    land(folder, 4, [tick("KRW-A", 1, at=240_000)])
    job.run_available(landed_messages(seoul, folder, max_files=1), config)
    assert rows(read_published(seoul, config.output), "one_m_trade_volume")[(6.0,)] == 1


@pytest.mark.parametrize("apart", [True, False])
def test_slowest_of_several_streams_closes_a_window(seoul, place, apart):
    config, folder = place
    fast, slow = folder + "/fast", folder + "/slow"
    for number in range(6):
        land(fast, number, [tick("KRW-F", 1, at=(number + 5) * 60_000 + 5_000)])
        land(slow, number, [tick("KRW-S", 1, at=number * 60_000 + 5_000)])
    streams = [landed_messages(seoul, path, max_files=1) for path in (fast, slow)]
    if not apart:
        streams = streams[0].unionByName(streams[1])
    query = job.run_available(streams, config)
    published = rows(read_published(seoul, config.output), "market")
    if apart:
        # Own watermarks: nothing of the slow stream is late, the fast one waits.
        assert job.late_groups(query) == 0 and published == {("KRW-S",): 5}
    else:
        assert job.late_groups(query) > 0 and published[("KRW-S",)] < 5


def test_disorder_within_the_delay_changes_nothing(seoul, tmp_path):
    config = exchange_a(
        str(tmp_path / "out"), str(tmp_path / "check"), delay="30 seconds", shuffle_partitions=4
    )
    folder, rng = str(tmp_path / "land"), random.Random(7)
    ticks = [m for batch in random_minutes(6, 6) for m in batch if isinstance(m, dict)]
    ticks.sort(key=lambda t: t["timestamp"] + rng.randrange(30_000))
    for number in range(8):
        land(folder, number, ticks[number * 30 : (number + 1) * 30])
    query = job.run_available(landed_messages(seoul, folder, max_files=1), config)
    assert job.late_groups(query) == 0
    want = top_markets(stored_messages(seoul, folder), config).where(
        f"window_end <= cast(timestamp_millis({newest_time([ticks]) - 30_000}) as timestamp_ntz)"
    )
    assert rows(read_published(seoul, config.output), *KEYS) == rows(want, *KEYS)


def test_undated_and_broken_messages_do_not_stop_the_job(seoul, place):
    config, folder = place
    odd = ["junk", "[]", {"market": "KRW-A"}, {**tick("KRW-A", 1), "timestamp": 2**63 - 1}]
    land(folder, 0, [*odd, tick("KRW-A", 1), tick("KRW-A", 1, at=120_000)])
    job.run_available(landed_messages(seoul, folder), config)
    assert rows(read_published(seoul, config.output), "market", "one_m_trade_volume") == {
        ("KRW-A", 1.0): 1
    }


def test_session_in_another_zone_is_refused(spark, place):
    config, folder = place
    land(folder, 0, [tick("KRW-A", 1)])
    with pytest.raises(ValueError, match="zone"):
        job.start_job(landed_messages(spark, folder), config)


def test_two_exchanges_run_apart(spark, seoul, tmp_path):
    jobs = []
    for name, make, column in (("a", exchange_a, "market"), ("b", exchange_b, "code")):
        config = make(
            str(tmp_path / name / "out"), str(tmp_path / name / "check"), shuffle_partitions=2
        )
        folder = str(tmp_path / name / "land")
        messages = [tick("KRW-A", 1), tick("KRW-A", 1, at=120_000)]
        for message in messages:
            message[column] = message.pop("market") + name
        land(folder, 0, messages)
        session = config.session(spark)
        query = job.start_job(landed_messages(session, folder), config, {"availableNow": True})
        jobs.append((query, config, name))
    for query, config, name in jobs:
        query.awaitTermination()
        assert rows(read_published(seoul, config.output), "market") == {("KRW-A" + name,): 1}


@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}], ids=["broadcast", "shuffled"])
def test_pushed_frames_as_a_stream(seoul, tmp_path, limits):
    names = seoul.createDataFrame([("KRW-A", "a"), ("KRW-B", "b")], "market string, name string")
    folder = str(tmp_path / "frames")
    land(folder, 0, [{"code": "KRW-A", "trade_price": 1}, {"code": "KRW-Z"}, "junk", {"code": None}])
    messages = pushed_messages(landed_messages(seoul, folder), names, **limits)
    out = str(tmp_path / "messages")
    check, once = str(tmp_path / "check"), {"availableNow": True}
    stream_to_folder(messages, out, check, trigger=once, text="value").awaitTermination()
    frame = read_back(seoul, out, "code string, name string, trade_price double")
    assert rows(frame) == {("KRW-A", "a", 1.0): 1, ("KRW-Z", None, None): 1, (None, None, None): 1}


def test_polled_payloads_as_a_stream(seoul, tmp_path):
    markets = seoul.createDataFrame([("KRW-A", "a")], "market string, name string")
    folder = str(tmp_path / "quotes")
    land(folder, 0, ['[{"market": "KRW-A",', ' "trade_price": 2}]'])
    land(folder, 1, ['[{"market": "KRW-X"}]'])
    messages = polled_messages(markets, stream_payloads(seoul, folder, max_files=1))
    out = str(tmp_path / "messages")
    check, once = str(tmp_path / "check"), {"availableNow": True}
    stream_to_folder(messages, out, check, trigger=once, text="value").awaitTermination()
    frame = read_back(seoul, out, "market string, name string, trade_price double")
    assert rows(frame) == {("KRW-A", "a", 2.0): 1}


def test_order_and_split_of_on_time_input_do_not_matter(seoul, tmp_path):
    batches = list(random_minutes(4, 3))
    whole = [m for batch in batches for m in batch]
    config = exchange_a("", "")
    want = rows(top_markets(table_of(seoul, whole), config))
    for seed in range(3):
        shuffled = whole[:]
        random.Random(seed).shuffle(shuffled)
        messages = table_of(seoul, shuffled).repartition(seed + 1)
        assert rows(top_markets(messages, config)) == want


def test_stream_needs_no_python_worker(seoul, place):
    config, folder = place
    land(folder, 0, [tick("KRW-A", 1)])
    plan = notional_per_window(landed_messages(seoul, folder), config)
    text = plan._jdf.queryExecution().analyzed().toString()
    assert "Python" not in text and "EventTimeWatermark" in text


CRASH = """
import os, signal, sys
from pyspark.sql import SparkSession
import tickflow.jobs.job as job
from tickflow.config import exchange_a
from tickflow.sources.ticks import landed_messages

out, check, folder, checkpoints = sys.argv[1:]
spark = (
    SparkSession.builder.master("local[4]")
    .config("spark.ui.enabled", "false")
    .config("spark.checkpoint.dir", checkpoints)
    .getOrCreate()
)
jvm = spark._jvm.java.lang.ProcessHandle.current().pid()
publish, calls = job.publish_result, []

def crash(*args):
    calls.append(publish(*args))
    if len(calls) == 3:
        os.kill(jvm, signal.SIGKILL)
        os._exit(9)

job.publish_result = crash
config = exchange_a(out, check, shuffle_partitions=4)
session = config.session(spark)
job.run_available(landed_messages(session, folder, max_files=1), config)
"""


def test_killed_process_is_taken_over(seoul, place, tmp_path):
    config, folder = place
    batches = list(random_minutes(5, 6))
    for number, batch in enumerate(batches):
        land(folder, number, batch)
    root = os.path.dirname(os.path.dirname(os.path.abspath(job.__file__)))
    done = subprocess.run(
        [sys.executable, "-c", CRASH, config.output, config.checkpoint, folder, str(tmp_path / "c")],
        env={**os.environ, "PYTHONPATH": os.path.dirname(root)},
        capture_output=True,
        timeout=300,
    )
    assert done.returncode == 9, done.stderr.decode()[-2000:]
    job.run_available(landed_messages(seoul, folder, max_files=1), config)
    want = closed(seoul, folder, config, newest_time(batches))
    assert rows(read_published(seoul, config.output), *KEYS) == rows(want, *KEYS)
