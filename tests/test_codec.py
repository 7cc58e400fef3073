from __future__ import annotations

import json

import pytest

from helpers import SAMPLE_LISTING, SAMPLE_QUOTE, rows, table_of
from tickflow.functions.codec import decode_first, decode_json, decode_listing, encode_json
from tickflow.schemas import LISTING, POLLED, PUSHED, TICKS_A, TICKS_B


@pytest.mark.parametrize(
    "message",
    [
        "not json", '{"market":"KRW-A"', "[]", "null", "", "   ", "\t", "5", '"text"',
        "{'market':'KRW-A'}", '{"market":"KRW-A","trade_price":NaN}', "{market:1}",
    ],
)
def test_message_that_is_no_object_is_skipped(spark, message):
    good = {"market": "KRW-A"}
    decoded = decode_json(table_of(spark, [message, good]), TICKS_A, POLLED.needed)
    assert rows(decoded, "market") == {("KRW-A",): 1}


def test_null_message_is_skipped(spark):
    messages = spark.createDataFrame([(None,)], "value string")
    assert decode_json(messages, TICKS_A).count() == 0


def test_field_faults_become_null(spark):
    messages = [
        {"market": "bad", "trade_price": "abc", "trade_volume": 2},
        {"market": "text", "trade_price": "1.5", "trade_volume": " 2 "},
        {"market": "missing"},
        {"market": "extra", "trade_price": 3, "extra": {"a": [1]}},
        {"Market": "case", "trade_price": 4},
        {"market": {"a": 1}, "trade_price": 5},
        {"market": None, "trade_price": None},
        {},
    ]
    decoded = decode_json(table_of(spark, messages), TICKS_A, POLLED.needed)
    assert rows(decoded, "market", "trade_price", "trade_volume") == {
        ("bad", None, 2.0): 1,
        ("text", 1.5, 2.0): 1,
        ("missing", None, None): 1,
        ("extra", 3.0, None): 1,
        (None, 4.0, None): 1,
        ('{"a":1}', 5.0, None): 1,
        (None, None, None): 2,
    }


def test_all_declared_columns_and_types(spark):
    assert len(TICKS_A) == 27 and len(TICKS_B) == 34
    decoded = decode_json(table_of(spark, [SAMPLE_QUOTE]), TICKS_A)
    assert decoded.schema == TICKS_A
    row = decoded.first()
    assert row.opening_price == 144520000.0 and row.trade_timestamp == 1746886463399
    assert row.signed_change_rate == -0.0021 and row.name is None
    pushed = decode_json(
        table_of(spark, [{"code": "KRW-BTC", "is_trading_suspended": False}]), PUSHED.schema
    )
    assert pushed.schema == TICKS_B
    assert pushed.first().is_trading_suspended is False


def test_keep_carries_columns(spark):
    messages = spark.createDataFrame([(7, '{"market":"a"}'), (8, "x")], "id int, value string")
    assert rows(decode_json(messages, TICKS_A, ["market"], keep=["id"])) == {(7, "a"): 1}


def test_listing_rows(spark):
    payloads = table_of(spark, [json.dumps(SAMPLE_LISTING * 2), "[]", "broken"])
    decoded = decode_listing(payloads, LISTING)
    assert rows(decoded) == {
        (0, "KRW-BTC", "비트코인", "Bitcoin"): 1,
        (1, "KRW-BTC", "비트코인", "Bitcoin"): 1,
    }


def test_first_quote(spark):
    other = {"market": "KRW-ETH"}
    payloads = table_of(spark, [json.dumps([SAMPLE_QUOTE, other]), "[]", json.dumps([other])])
    decoded = decode_first(payloads, TICKS_A)
    assert rows(decoded, "market", "trade_price") == {
        ("KRW-BTC", 144210000.0): 1,
        ("KRW-ETH", None): 1,
    }


def test_error_object_has_no_market(spark):
    payloads = table_of(spark, ['{"error": {"name": 404}}'])
    assert rows(decode_first(payloads, TICKS_A), "market", "timestamp") == {(None, None): 1}


def test_encode_keeps_nulls_and_text(spark):
    frame = spark.createDataFrame([("비트", None, 1.5)], "name string, note string, price double")
    encoded = encode_json(frame)
    assert encoded.columns == ["value"]
    assert json.loads(encoded.first().value) == {"name": "비트", "note": None, "price": 1.5}


def test_roundtrip(spark):
    decoded = decode_json(table_of(spark, [SAMPLE_QUOTE]), TICKS_A)
    again = decode_json(encode_json(decoded), TICKS_A)
    assert decoded.collect() == again.collect()
