"""Manifests of published days: commits, compaction and their readers."""

from __future__ import annotations

import glob
import json
import os
import shutil

import pytest

import tickflow.sinks.published as sink
from helpers import rows, table_of, tick
from tickflow.config import exchange_a
from tickflow.plans.newest import newest_file
from tickflow.plans.queries import sink_compacted
from tickflow.plans.ticks import backfill, top_markets
from tickflow.schemas import RESULT
from tickflow.sinks.manifest import Entry, Store
from tickflow.sinks.published import compact_day, compact_days, publish_result, touched_days, write_published
from tickflow.sources.published import read_day, read_published

DAY = 24 * 3600 * 1000
FIRST = ("2025", "05", "10")


@pytest.fixture(scope="module")
def result(seoul):
    messages = [tick(f"KRW-{m}", m + 1, at=day * DAY + w * 60_000) for day in (0, 1, 25)
                for w in range(3) for m in range(7)]
    top = top_markets(table_of(seoul, messages), exchange_a("", ""))
    return seoul.createDataFrame(top.collect(), top.schema).coalesce(2)


@pytest.fixture(scope="module")
def template(result, tmp_path_factory):
    """Three days in three batches."""
    root = str(tmp_path_factory.mktemp("published") / "out")
    for batch, part in (("b1", "row_num <= 2"), ("b2", "row_num = 3"), ("b3", "row_num > 3")):
        publish_result(result.where(part), root, batch)
    return root


@pytest.fixture
def published(template, tmp_path):
    return shutil.copytree(template, str(tmp_path / "out"))


def batches(spark, root, day=FIRST):
    return Store(spark, root).manifest(day).batches


def folders(root, day=FIRST):
    path = f"{root}/year={day[0]}/month={day[1]}/day={day[2]}"
    return sorted(x for x in os.listdir(path) if x.startswith("batch="))


def test_commits_are_listed_in_their_order(spark, published, result):
    assert batches(spark, published) == ["b1", "b2", "b3"]
    publish_result(result.where("row_num <= 2"), published, "b1")
    assert batches(spark, published) == ["b2", "b3", "b1"]
    assert rows(newest_file(spark, published, FIRST)) == rows(result.where("day = '10' and row_num <= 2"), *RESULT.names)
    # Only the newest lists stay.
    assert len(glob.glob(f"{published}/**/day=10/_manifest/*.json", recursive=True)) == 3


def test_a_folder_that_is_not_listed_does_not_count(spark, published, result):
    before = rows(read_published(spark, published))
    write_published(result, published, "unlisted")
    assert rows(read_published(spark, published)) == before
    assert rows(read_day(spark, published, *FIRST)) == rows(result.where("day = '10'"))


def test_days_without_a_manifest_are_read_as_they_are(spark, result, tmp_path):
    root = str(tmp_path / "out")
    write_published(result.where("day = '10'"), root, "old")
    publish_result(result.where("day != '10'"), root, "new")
    assert rows(read_published(spark, root)) == rows(result)
    # The first commit takes on what is there.
    publish_result(result.where("day = '10'"), root, "again")
    assert batches(spark, root) == ["old", "again"]
    assert read_day(spark, root, *FIRST).count() == 30


def test_compaction_keeps_rows_and_leaves_one_file_a_day(spark, published, result):
    compact_days(spark, published, "done")
    assert rows(read_published(spark, published)) == rows(result)
    for day in touched_days(result):
        day = tuple(day)
        assert len(folders(published, day)) == 1
        assert len(glob.glob(f"{published}/year={day[0]}/month={day[1]}/day={day[2]}/batch=*/*.json")) == 1
    assert not glob.glob(f"{published}/_done*")
    compact_days(spark, published, "done")  # nothing is left to do
    assert rows(read_published(spark, published)) == rows(result)


def test_one_job_writes_all_days(spark, published, result, monkeypatch):
    written = []
    options = sink.write_options
    monkeypatch.setattr(sink, "write_options", lambda writer: written.append(1) or options(writer))
    compact_days(spark, published, "done")
    assert len(written) == 1


STEPS = ["rename", "commit", "delete"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("when", ["before", "after"])
@pytest.mark.parametrize("number", [1, 3])
def test_a_reader_between_any_two_steps_sees_every_row_once(spark, published, result, monkeypatch, step, when, number):
    """The compaction dies at each of its steps; readers before and after the repair."""
    want = rows(result)
    kept, calls = getattr(Store, step), []

    def dying(self, *args):
        calls.append(args)
        if len(calls) == number and when == "before":
            raise RuntimeError("died on purpose")
        kept(self, *args)
        if len(calls) == number:
            raise RuntimeError("died on purpose")

    monkeypatch.setattr(sink, "each", lambda days, action: [action(d) for d in days])
    monkeypatch.setattr(Store, step, dying)
    with pytest.raises(RuntimeError, match="died"):
        compact_days(spark, published, "done")
    monkeypatch.setattr(Store, step, kept)
    assert rows(read_published(spark, published)) == want
    assert rows(read_day(spark, published, *FIRST)) == rows(result.where("day = '10'"))
    compact_days(spark, published, "done")
    assert rows(read_published(spark, published)) == want
    assert all(len(batches(spark, published, tuple(day))) == 1 for day in touched_days(result))


def test_a_reader_at_every_step(spark, published, result, monkeypatch):
    want, seen = rows(result), []
    for step in STEPS:
        kept = getattr(Store, step)

        def watched(self, *args, kept=kept):
            seen.append(rows(read_published(spark, published)))
            out = kept(self, *args)
            seen.append(rows(read_published(spark, published)))
            return out

        monkeypatch.setattr(Store, step, watched)
    compact_days(spark, published, "done")
    assert len(seen) > 12 and all(s == want for s in seen)


def test_what_is_published_meanwhile_stays(spark, published, result, monkeypatch):
    """Between the compaction's job and its swap."""
    kept, once = Store.rename, []

    def late(self, *args):
        if not once:
            once.append(1)
            publish_result(result.where("row_num = 1"), published, "late")
        return kept(self, *args)

    monkeypatch.setattr(Store, "rename", late)
    compact_day(spark, published, touched_days(result.where("day = '10'"))[0], "done")
    assert batches(spark, published)[1:] == ["late"]
    assert read_day(spark, published, *FIRST).count() == 15 + 3


def test_a_day_that_changed_meanwhile_is_left_alone(spark, published, result, monkeypatch):
    kept, once = Store.rename, []

    def late(self, *args):
        if not once:
            once.append(1)
            publish_result(result.where("row_num = 1"), published, "b1")
        return kept(self, *args)

    monkeypatch.setattr(Store, "rename", late)
    compact_day(spark, published, touched_days(result.where("day = '10'"))[0], "done")
    assert batches(spark, published) == ["b2", "b3", "b1"] and folders(published) == ["batch=b1", "batch=b2", "batch=b3"]
    assert read_day(spark, published, *FIRST).count() == 3 + 3 + 6


def test_a_compacted_batch_that_is_repeated_counts_once(spark, published, result):
    compact_days(spark, published, "done")
    publish_result(result.where("row_num = 3"), published, "b2")
    assert rows(read_published(spark, published)) == rows(result)
    assert len(folders(published)) == 1
    with pytest.raises(ValueError, match="compacted"):
        publish_result(result.where("row_num = 3"), published, "b2", rerun=True)


def test_compacted_again(spark, published, result):
    compact_days(spark, published, "done")
    publish_result(result.where("row_num = 1"), published, "more")
    compact_days(spark, published, "done")
    assert read_published(spark, published).count() == result.count() + 9
    entry = Store(spark, published).manifest(FIRST).entries[0]
    assert entry.of == ("b1", "b2", "b3", "more")


def test_a_day_whose_rows_are_all_withdrawn(seoul, tmp_path):
    config = exchange_a(str(tmp_path / "out"), "")
    backfill(table_of(seoul, [tick("KRW-A", 1)]), config, "one")
    backfill(table_of(seoul, ["x"]), config, "one")
    assert read_published(seoul, config.output).count() == 0
    assert read_day(seoul, config.output, *FIRST).count() == 0
    assert newest_file(seoul, config.output, FIRST).count() == 0


def test_writers_do_not_overlook_each_other(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    store = Store(spark, str(tmp_path))
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: Store(spark, str(tmp_path)).commit(FIRST, lambda e: (*e, Entry(f"b{i}"))), range(12)))
    assert sorted(store.manifest(FIRST).batches) == sorted(f"b{i}" for i in range(12))


def test_an_unreadable_list_is_passed_over(spark, published):
    paths = sorted(glob.glob(f"{published}/**/day=10/_manifest/*.json", recursive=True))
    broken = paths[-1].replace("000000000003", "000000000004")
    with open(broken, "w") as out:
        out.write('[{"batch": "b')
    assert batches(spark, published) == ["b1", "b2", "b3"]
    assert json.load(open(paths[-1]))[0]["batch"] == "b1"


def test_registered_query(spark, tables):
    assert sink_compacted(spark, tables.replace("sf0.01", "sf0.001")).count() > 0
