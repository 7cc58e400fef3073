"""The physical plans: what is read, parsed, cut early and shuffled."""

from __future__ import annotations

import pytest

from helpers import table_of, tick
from tickflow.config import exchange_a
from tickflow.plans.queries import QUERIES
from tickflow.plans.ticks import top_markets


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_message_is_parsed_once(spark):
    text = plan(top_markets(table_of(spark, [tick("KRW-A", 1)]), exchange_a("", "")))
    assert text.count("from_json(") == 1
    # Only what the result needs is decoded.
    assert "high_price" not in text and "trade_timestamp" not in text


def test_scan_reads_only_the_columns_used(spark, tables):
    text = plan(QUERIES["top5_day"](spark, tables))
    schema = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate",
    }


def test_rank_is_cut_before_the_shuffle(spark, tables):
    text = plan(QUERIES["top5_day"](spark, tables))
    partial = text.index("row_number(), 5, Partial")
    assert text.index("row_number(), 5, Final") < partial
    assert "Exchange" in text[:partial] and text.count("Exchange") == 2


def test_sums_are_combined_before_the_shuffle(spark, tables):
    text = plan(QUERIES["notional_day"](spark, tables))
    assert text.count("Exchange") == 1 and "partial_sum" in text


def test_filter_reaches_the_scan(spark, tables):
    text = plan(QUERIES["prefix_filter"](spark, tables))
    assert "PushedFilters: [IsNotNull(p_name), StringStartsWith(p_name,red)]" in text


BATCH = [
    name for name in QUERIES
    if not name.startswith("stream_") and "roundtrip" not in name and "rewrite" not in name
]


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python_in_any_plan(spark, tables, name):
    text = plan(QUERIES[name](spark, tables.replace("sf0.01", "sf0.001")))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert word not in text


def test_a_message_is_encoded_once(spark, tables):
    for name, times in (("encode_roundtrip", 1), ("pushed_top5_minute", 2)):
        text = QUERIES[name](spark, tables)._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("StructsToJsonEvaluator") + text.count("to_json(") == times, text
