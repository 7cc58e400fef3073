from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest

from helpers import rows
from tickflow.operators.rank import rank_all, top_n
from tickflow.scratch import remove_folders, shared_root

START = datetime(2025, 1, 1)
COLUMNS = (
    "name string, market string, window_start timestamp_ntz, window_end timestamp_ntz, "
    "one_m_trade_volume double"
)


def groups(spark, *entries, tasks=1):
    data = [
        (name, market, START + timedelta(minutes=w), START + timedelta(minutes=w + 1), value)
        for w, market, name, value in entries
    ]
    return spark.createDataFrame(data, COLUMNS).repartition(tasks)


@pytest.mark.parametrize("size,kept", [(0, 0), (3, 3), (5, 5), (6, 5), (40, 5)])
def test_at_most_five_per_window(spark, size, kept):
    frame = groups(spark, *[(0, f"m{i:02d}", "n", float(i)) for i in range(size)], tasks=4)
    top = top_n(frame)
    assert sorted(r.row_num for r in top.collect()) == list(range(1, kept + 1))
    assert {r.one_m_trade_volume for r in top.collect()} == {float(i) for i in range(size - kept, size)}


def test_windows_are_ranked_apart(spark):
    frame = groups(spark, *[(w, f"m{i}", "n", float(i * w)) for w in range(3) for i in range(7)])
    assert list(rows(top_n(frame), "window_start").values()) == [5, 5, 5]


def test_ties_by_market_then_name_and_nulls_last(spark):
    frame = groups(
        spark,
        (0, "b", "y", 1.0),
        (0, "b", "x", 1.0),
        (0, "a", "z", 1.0),
        (0, "c", "c", None),
        (0, "d", "d", 2.0),
        (0, "e", "e", -5.0),
    )
    want = [("d", "d", 1), ("a", "z", 2), ("b", "x", 3), ("b", "y", 4), ("e", "e", 5), ("c", "c", 6)]
    got = sorted(rank_all(frame).select("market", "name", "row_num").collect(), key=lambda r: r[2])
    assert [tuple(r) for r in got] == want
    top = sorted(top_n(frame).select("market", "name", "row_num").collect(), key=lambda r: r[2])
    assert [tuple(r) for r in top] == want[:5]


def test_rank_all_splits_a_crowded_window(spark):
    # One window holds nearly all rows, many of them equal in value.
    entries = [(0, f"m{i:05d}", "n", float(i % 7)) for i in range(5000)]
    entries += [(w, f"m{i}", "n", float(i)) for w in range(1, 4) for i in range(10)]
    frame = groups(spark, *entries, tasks=5)
    ranked = rank_all(frame)
    whole = top_n(frame, n=10**9)
    assert rows(ranked) == rows(whole, *ranked.columns)
    assert ranked.schema["row_num"].dataType.simpleString() == "bigint"


def test_top_n_is_the_head_of_rank_all(spark):
    frame = groups(spark, *[(i % 3, f"m{i}", "n", float((i * 37) % 11)) for i in range(60)], tasks=3)
    head = rank_all(frame).where("row_num <= 5")
    assert rows(head) == rows(top_n(frame), *head.columns)


def test_many_rows_per_window_are_ranked_without_one_task_per_window(spark):
    frame = spark.range(3000).selectExpr(
        "'a' as name", "concat('m', id) as market", "id % 2 as window_start", "0 as window_end",
        "cast(id as double) as one_m_trade_volume",
    )
    for n in (1000, 1001):
        got = top_n(frame, n).select("window_start", "one_m_trade_volume", "row_num").collect()
        assert len(got) == 2 * n
        assert all(r.one_m_trade_volume == 2998 + r.window_start - 2 * (r.row_num - 1) for r in got)


def test_ranking_leaves_nothing_behind(spark):
    frame = spark.range(50).selectExpr(
        "'a' as name", "concat('m', id) as market", "0 as window_start", "0 as window_end",
        "cast(id as double) as one_m_trade_volume",
    )
    remove_folders(spark)
    root = f"{shared_root(spark)}/tickflow"
    before = len(os.listdir(root)) if os.path.isdir(root) else 0
    for _ in range(2):
        assert rank_all(frame).count() == 50
    assert len(os.listdir(root)) == before + 2
    remove_folders(spark)
    assert len(os.listdir(root)) == before
