"""The last row of every key of a stream, as a table."""

from __future__ import annotations

import os

import pytest

import tickflow.jobs.latest as latest
from helpers import rows, table_of
from tickflow.operators.markets import attach_name, last_by_key
from tickflow.schemas import struct
from tickflow.sinks.steps import newest_step

SCHEMA = struct("market string, name string, at long")
ONCE = {"availableNow": True}


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "land"), str(tmp_path / "table"), str(tmp_path / "check")


def put(seoul, folder, number, data):
    seoul.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(f"{folder}/part={number}")


def run(seoul, place, max_files=1):
    folder, root, check = place
    reader = seoul.readStream.schema(SCHEMA).option("maxFilesPerTrigger", max_files)
    stream = reader.option("recursiveFileLookup", "true").parquet(folder)
    query = latest.start_latest(stream, "market", ["at"], root, check, ONCE)
    query.awaitTermination()
    return query


LANDINGS = [
    [("KRW-A", "a1", 1), ("KRW-B", "b5", 5), (None, "none", 1)],
    [("KRW-A", "a3", 3), ("KRW-A", "a2", 2), ("KRW-B", "b4", 4), ("KRW-C", None, 0)],
    [("KRW-B", "b6", 6), (None, "newer", 2)],
    [("KRW-D", "d", 9), ("KRW-A", "a0", 0)],
]


def want(seoul, landings):
    frame = seoul.createDataFrame([r for data in landings for r in data], SCHEMA)
    return rows(last_by_key(frame, "market", ["at"]))


def test_table_follows_the_stream(seoul, place):
    folder, root, _ = place
    assert latest.read_latest(seoul, root, SCHEMA).count() == 0
    for number, data in enumerate(LANDINGS):
        put(seoul, folder, number, data)
        run(seoul, place)
        assert rows(latest.read_latest(seoul, root, SCHEMA)) == want(seoul, LANDINGS[: number + 1])


def test_restart_without_new_rows_changes_nothing(seoul, place):
    folder, root, _ = place
    put(seoul, folder, 0, LANDINGS[0])
    run(seoul, place)
    run(seoul, place)
    put(seoul, folder, 1, LANDINGS[1])
    run(seoul, place)
    run(seoul, place)
    assert rows(latest.read_latest(seoul, root, SCHEMA)) == want(seoul, LANDINGS[:2])


@pytest.mark.parametrize("stage", ["before", "written"])
def test_failed_micro_batch_is_repeated(seoul, place, monkeypatch, stage):
    folder, root, _ = place
    for number, data in enumerate(LANDINGS):
        put(seoul, folder, number, data)
    kept, calls = latest.put_step, []

    def failing(version, where, number):
        calls.append(number)
        if stage == "written":
            kept(version, where, number)
        if len(calls) == 2:
            raise RuntimeError("lost on purpose")
        if stage == "before":
            kept(version, where, number)

    monkeypatch.setattr(latest, "put_step", failing)
    with pytest.raises(Exception, match="lost on purpose"):
        run(seoul, place)
    run(seoul, place)
    assert calls.count(calls[1]) == 2
    assert rows(latest.read_latest(seoul, root, SCHEMA)) == want(seoul, LANDINGS)


def test_an_unfinished_version_is_not_read(seoul, place):
    folder, root, _ = place
    put(seoul, folder, 0, LANDINGS[0])
    run(seoul, place)
    before = rows(latest.read_latest(seoul, root, SCHEMA))
    seoul.createDataFrame(LANDINGS[1], SCHEMA).write.parquet(f"{root}/step={99:012d}")
    os.remove(f"{root}/step={99:012d}/_SUCCESS")
    assert rows(latest.read_latest(seoul, root, SCHEMA)) == before
    assert newest_step(seoul, root, SCHEMA, below=0) is None


def test_only_the_newest_versions_are_kept(seoul, place):
    folder, root, _ = place
    for number in range(6):
        put(seoul, folder, number, [("KRW-A", str(number), number)])
    run(seoul, place)
    steps = sorted(x for x in os.listdir(root) if x.startswith("step="))
    assert len(steps) == 3 and latest.read_latest(seoul, root, SCHEMA).first().name == "5"


def test_lookups_read_the_table(seoul, place):
    folder, root, _ = place
    put(seoul, folder, 0, LANDINGS[0])
    put(seoul, folder, 1, LANDINGS[1])
    run(seoul, place)
    names = latest.read_latest(seoul, root, SCHEMA).where("market is not null").select("market", "name")
    ticks = table_of(seoul, ["KRW-A", "KRW-Z"]).withColumnRenamed("value", "market")
    assert rows(attach_name(ticks, names)) == {("KRW-A", "a3"): 1, ("KRW-Z", None): 1}


def many(number):
    return [(None if k == 0 else f"KRW-{k}", f"{k} in {number}", number) for k in range(number * 30, 100)]


def test_state_is_not_gathered_in_one_task(seoul, place):
    folder, root, _ = place
    put(seoul, folder, 0, many(0))
    query = run(seoul, place)
    tracker = seoul.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(str(query.runId))]
    tasks = [tracker.getStageInfo(s).numTasks for job in jobs for s in job.stageIds]
    # One file is read; the state has so many partitions.
    assert max(tasks) == int(seoul.conf.get("spark.sql.shuffle.partitions")) > 1


@pytest.mark.parametrize("file_rows, least, most", [(1000, 1, 1), (10, 5, 20)])
def test_files_of_a_version_follow_the_number_of_keys(seoul, place, monkeypatch, file_rows, least, most):
    folder, root, _ = place
    monkeypatch.setattr(latest, "FILE_ROWS", file_rows)
    for number in range(3):
        put(seoul, folder, number, many(number))
        run(seoul, place)
        newest = max(x for x in os.listdir(root) if x.startswith("step="))
        parts = [x for x in os.listdir(f"{root}/{newest}") if x.startswith("part-")]
        assert least <= len(parts) <= most
        assert rows(latest.read_latest(seoul, root, SCHEMA)) == want(seoul, [many(n) for n in range(number + 1)])
