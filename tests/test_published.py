from __future__ import annotations

import glob
import json
import os
from datetime import datetime

import pytest

from helpers import rows, same, table_of, tick
from tickflow.config import exchange_a
from tickflow.plans.newest import newest_file, newest_window
from tickflow.plans.ticks import backfill, top_markets
from tickflow.schemas import PUBLISHED, RESULT
from tickflow.sinks.published import (
    mark_partitions,
    marked_days,
    publish_result,
    touched_days,
    write_published,
)
from tickflow.sources.published import published_days, published_files, read_day, read_published

DAY = 24 * 3600 * 1000


@pytest.fixture
def result(seoul):
    messages = [tick(f"KRW-{m}", m + 1, at=day * DAY + w * 60_000) for day in (0, 1, 25)
                for w in range(3) for m in range(7)]
    messages.append({**tick("KRW-N", 1000), "name": None})
    return top_markets(table_of(seoul, messages), exchange_a("", ""))


def test_roundtrip_keeps_values_and_text_keys(seoul, result, tmp_path):
    root = str(tmp_path / "out")
    publish_result(result, root, "b1")
    read = read_published(seoul, root)
    assert read.schema == PUBLISHED
    same(read, result)
    assert rows(read, "year", "month", "day").keys() == {
        ("2025", "05", "10"), ("2025", "05", "11"), ("2025", "06", "04"),
    }


def test_file_form(result, tmp_path):
    root = str(tmp_path / "out")
    publish_result(result, root, "b1")
    files = glob.glob(f"{root}/year=2025/month=05/day=10/batch=b1/*.json")
    assert len(files) == 1
    lines = [json.loads(line) for line in open(files[0], encoding="utf-8")]
    first = next(line for line in lines if line["market"] == "KRW-N")
    assert first == {
        "name": None,
        "market": "KRW-N",
        "window_start": "2025-05-10 14:14:00",
        "window_end": "2025-05-10 14:15:00",
        "one_m_trade_volume": 1000.0,
        "row_num": 1,
    }


def test_same_batch_replaces_other_batches_stay(seoul, result, tmp_path):
    root = str(tmp_path / "out")
    publish_result(result.where("day = '10'"), root, "b1")
    publish_result(result, root, "b2")
    publish_result(result, root, "b2")
    read = read_published(seoul, root)
    assert read.count() == result.count() + result.where("day = '10'").count()
    publish_result(result.where("row_num = 1"), root, "b1")
    assert read_published(seoul, root).count() == result.count() + 9


def test_markers(spark, result, tmp_path):
    root = str(tmp_path / "out")
    write_published(result, root, "b1")
    assert marked_days(spark, root).count() == 0
    days = touched_days(result)
    mark_partitions(spark, root, days)
    mark_partitions(spark, root, days)
    assert rows(marked_days(spark, root)) == rows(result.select("year", "month", "day").distinct())
    same(published_days(spark, root), marked_days(spark, root))
    assert os.path.exists(f"{root}/year=2025/month=06/day=04/_SUCCESS")
    # Markers are no data.
    assert read_day(spark, root, "2025", "06", "04").count() == 15


def test_day_scan_reads_one_day_only(spark, result, tmp_path):
    root = str(tmp_path / "out")
    publish_result(result, root, "b1")
    day = read_day(spark, root, "2025", "05", "11")
    assert rows(day) == rows(result.where("day = '11'"))
    assert all("/day=11/" in file for file in day.inputFiles())
    pruned = read_published(spark, root).where("month = '06' and day = '04'")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert pruned.count() == 15


def test_day_without_output_is_empty(spark, result, tmp_path):
    root = str(tmp_path / "out")
    publish_result(result, root, "b1")
    empty = read_day(spark, root, "1999", "01", "01")
    assert empty.count() == 0 and empty.schema == PUBLISHED
    assert newest_file(spark, root, ("1999", "01", "01")).count() == 0
    assert newest_window(spark, root).count() == 0  # today


def test_empty_result_publishes_nothing(result, tmp_path):
    root = str(tmp_path / "out")
    publish_result(result.where("false"), root, "b1")
    assert not os.path.exists(root)
    assert read_published(result.sparkSession, root).count() == 0


def test_newest_window_in_rank_order(seoul, result, tmp_path):
    root = str(tmp_path / "out")
    publish_result(result, root, "b1")
    newest = newest_window(seoul, root, ("2025", "05", "10")).collect()
    assert [r.row_num for r in newest] == [1, 2, 3, 4, 5]
    assert {r.window_start for r in newest} == {datetime(2025, 5, 10, 14, 16)}


def test_newest_file_need_not_be_the_newest_window(seoul, result, tmp_path):
    root = str(tmp_path / "out")
    publish_result(result, root, "b1")
    early = result.where("window_start = timestamp_ntz'2025-05-10 14:14:00'")
    publish_result(early, root, "b2")
    for path in glob.glob(f"{root}/**/batch=b1/*.json", recursive=True):
        os.utime(path, (1_700_000_000, 1_700_000_000))
    newest = newest_file(seoul, root, ("2025", "05", "10"))
    assert newest.schema == RESULT
    assert rows(newest) == rows(early, *RESULT.names)


def test_listing_opens_no_file(spark, result, tmp_path):
    root = str(tmp_path / "out")
    publish_result(result, root, "b1")
    plan = published_files(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_backfill_is_repeatable(seoul, tmp_path):
    config = exchange_a(str(tmp_path / "out"), "")
    messages = table_of(seoul, [tick("KRW-A", 1), tick("KRW-B", 2)])
    backfill(messages, config, "2025-05")
    backfill(messages, config, "2025-05")
    assert rows(read_published(seoul, config.output), "market", "row_num") == {
        ("KRW-B", 1): 1, ("KRW-A", 2): 1,
    }
    assert rows(marked_days(seoul, config.output)) == {("2025", "05", "10"): 1}


def test_rerun_with_other_input_leaves_nothing_behind(seoul, tmp_path):
    config = exchange_a(str(tmp_path / "out"), "")
    first = [tick("KRW-A", 1), tick("KRW-B", 2, at=DAY)]
    backfill(table_of(seoul, first), config, "one")
    backfill(table_of(seoul, first), config, "two")
    backfill(table_of(seoul, [tick("KRW-C", 3, at=DAY)]), config, "one")
    assert rows(read_published(seoul, config.output), "market", "day") == {
        ("KRW-A", "10"): 1, ("KRW-B", "11"): 1, ("KRW-C", "11"): 1,
    }
    backfill(table_of(seoul, ["x"]), config, "one")
    assert read_published(seoul, config.output).count() == 2


@pytest.mark.parametrize("name", ["", "a/b", "*", "a b"])
def test_batch_names_are_plain(result, tmp_path, name):
    with pytest.raises(ValueError, match="batch names"):
        publish_result(result, str(tmp_path / "out"), name)
