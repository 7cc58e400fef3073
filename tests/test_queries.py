"""Every registered query against its SQL twin in another engine, on whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from oracle import compare, connect
from tickflow.plans.oracles import ORACLES
from tickflow.plans.queries import QUERIES


@pytest.fixture(scope="module")
def other(tables):
    return connect(tables)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry_module.queries().keys()
    assert ORACLES.keys() <= entry_module.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, tables, other, name):
    count, problem = compare(QUERIES[name](spark, tables), other, ORACLES[name])
    assert not problem
    assert count > 0


def test_entry(spark):
    frame = entry_module.entry(spark)
    assert frame.columns == [
        "market", "window_start", "window_end", "one_m_trade_volume", "row_num",
    ]
    assert frame.count() > 0


def test_oracle_notices_a_difference(spark, tables, other):
    wrong = QUERIES["top5_day"](spark, tables).where("row_num < 5")
    assert compare(wrong, other, ORACLES["top5_day"])[1]
