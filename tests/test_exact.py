"""Sums that do not depend on the order of addition."""

from __future__ import annotations

import math
import random
import struct
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

import tickflow.jobs.job as job
from helpers import land, rows, table_of, tick
from tickflow.config import exchange_a
from tickflow.operators.exact import HIGHEST, LOWEST, exact_floor_sum
from tickflow.operators.notional import windowed_notional
from tickflow.plans.queries import QUERIES
from tickflow.plans.ticks import top_markets
from tickflow.sources.published import read_published
from tickflow.sources.ticks import landed_messages


def bits(value):
    return None if value is None else struct.pack(">d", value)


def plain_floor(values):
    """The floor of the exact sum of what the grid holds of each value, rounded once."""
    unit = Fraction(2) ** LOWEST
    total = sum((int(Fraction(v) / unit) * unit for v in values), Fraction(0))
    return float(math.floor(total))


def summed(spark, groups, parts=3):
    data = [(g, v) for g, values in groups.items() for v in values]
    frame = spark.createDataFrame(data, "g int, v double").repartition(parts)
    return {r.g: r.s for r in frame.groupBy("g").agg(exact_floor_sum(F.col("v")).alias("s")).collect()}


def adversarial(rng, n):
    """Large values that cancel, around small ones that alone decide the floor."""
    large = [math.ldexp(rng.random(), rng.randrange(20, 94)) for _ in range(n)]
    small = [0.1, 0.2, 0.7, 1e-20, -1e-20, 2.0**-60, 1 - 2.0**-53] * 3
    values = large + [-x for x in large] + small
    rng.shuffle(values)
    return values


def test_any_order_and_any_number_of_partitions(spark):
    rng = random.Random(4)
    values = adversarial(rng, 40)
    want = plain_floor(values)
    seen, plain = set(), set()
    for parts in (1, 2, 7, 16):
        rng.shuffle(values)
        seen.add(bits(summed(spark, {0: values}, parts)[0]))
        plain.add(sum(values))
    assert seen == {bits(want)}
    # What this is for: plain sums of the same values differ.
    assert len(plain) > 1


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-(2.0**HIGHEST) / 2, max_value=2.0**HIGHEST / 2), max_size=12), min_size=1, max_size=40))
def test_every_double_in_reach(spark, groups):
    groups = {i: values for i, values in enumerate(groups) if values}
    if not groups:
        return
    got = summed(spark, groups)
    for i, values in groups.items():
        # A zero has no sign here.
        assert got[i] + 0.0 == plain_floor(values), values


@pytest.mark.parametrize(
    "values, want",
    [
        ([0.5, 0.5], 1.0),
        ([-0.5], -1.0),
        ([-0.5, -0.5], -1.0),
        ([-(2.0**-90)], -1.0),
        ([2.0**-90, -(2.0**-90)], 0.0),
        ([2.0**53, 1.0], 2.0**53),
        ([2.0**53, 1.0, 1.0], 2.0**53 + 2),
        ([-(2.0**95)] * 3, -3 * 2.0**95),
        ([5e-324], 0.0),
        ([None, 2.5], 2.0),
        ([None, None], None),
        ([1e300, 1.0], 1e300),
        ([float("inf"), 1.0], float("inf")),
    ],
)
def test_values(spark, values, want):
    assert summed(spark, {0: values}) == {0: want}


def test_not_a_number_stays_one(spark):
    assert math.isnan(summed(spark, {0: [float("nan"), 1.0]})[0])


def test_no_rows(spark):
    frame = spark.createDataFrame([], "v double")
    assert frame.agg(exact_floor_sum(F.col("v")).alias("s")).first().s is None
    assert frame.groupBy("v").agg(exact_floor_sum(F.col("v")).alias("s")).count() == 0


def test_one_row_per_task_key_and_window_is_shuffled(spark, tables):
    frame = QUERIES["notional_exact_day"](spark, tables)
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "partial_sum" in text
    assert "ObjectHashAggregate" not in text and "SortAggregate" not in text
    assert "Python" not in text and "Generate" not in text


def test_the_same_as_the_plain_sum_where_that_is_exact(spark, tables):
    """Whole prices and volumes: no rounding, so both agree."""
    whole = spark.read.parquet(f"{tables}/lineitem.parquet").select(
        F.floor("l_extendedprice").cast("double").alias("p"), "l_quantity", "l_shipdate", "l_suppkey"
    )
    both = [
        windowed_notional(whole, "l_shipdate", "p", "l_quantity", [F.col("l_suppkey").alias("market")], "1 day", exact)
        for exact in (False, True)
    ]
    assert rows(both[0]) == rows(both[1])


def test_the_job_sums_exactly(seoul, tmp_path):
    """0.1 ten times is one in whichever micro-batches it comes."""
    folder = str(tmp_path / "land")
    config = exchange_a(str(tmp_path / "out"), str(tmp_path / "check"), shuffle_partitions=4, exact=True)
    prices = [2.0**60, 0.1, 0.2, 0.7, -(2.0**60), 2.0**-53]
    for number, price in enumerate(prices):
        land(folder, number, [tick("KRW-A", price, at=number)])
    land(folder, 99, [tick("KRW-A", 1, at=120_000)])
    job.run_available(landed_messages(seoul, folder, max_files=1), config)
    messages = [tick("KRW-A", price, at=number) for number, price in enumerate(prices)]
    want = plain_floor(prices)
    assert read_published(seoul, config.output).first().one_m_trade_volume == want
    assert top_markets(table_of(seoul, messages), config).first().one_m_trade_volume == want
