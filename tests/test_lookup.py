from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tickflow.operators.lookup import fits_broadcast, lookup_join
from tickflow.plans.queries import QUERIES
from tickflow.session import tick_session


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows share one key, a fifth have none, many rows are copies."""
    n = F.col("id")
    key = (
        F.when(n % 3 == 0, F.lit(7))
        .when(n % 5 == 0, F.lit(None))
        .otherwise(n % 40)
        .cast("long")
    )
    return spark.range(0, 6000, 1, 6).select(key.alias("k"), (n % 4).alias("payload"))


@pytest.fixture(scope="module")
def names(spark):
    return spark.range(0, 30).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}], ids=["broadcast", "shuffled"])
def test_lookup_equals_plain_join(facts, names, how, limits):
    got = lookup_join(facts, names, "k", how, **limits)
    want = facts.join(names, "k", how)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want, *got.columns)


def test_size_is_measured(names):
    assert fits_broadcast(names)
    assert fits_broadcast(names, max_rows=30) and not fits_broadcast(names, max_rows=29)
    assert not fits_broadcast(names, max_bytes=100)
    assert fits_broadcast(names.where("false"), max_rows=0, max_bytes=0)


def test_only_a_measured_side_is_broadcast(facts, names):
    def plan(frame):
        return frame._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(lookup_join(facts, names, "k", "left"))
    assert "strategy=broadcast" not in plan(lookup_join(facts, names, "k", "left", max_rows=0))


def test_the_lookup_side_is_computed_once(spark, facts, names):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    counted = names.mapInArrow(count, names.schema)
    lookup_join(facts, counted, "k", "left").collect()
    assert seen.value == 30


def test_several_names_of_a_key_are_refused(facts, names):
    twice = names.union(names.where("k = 7"))
    with pytest.raises(ValueError, match="several rows"):
        lookup_join(facts, twice, "k", "left")
    assert rows(lookup_join(facts, twice, "k", "left_semi")) == rows(facts.join(names, "k", "left_semi"))


def test_a_crowded_key_is_split_over_tasks(spark, names, tmp_path):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        n = F.col("id")
        facts = spark.range(0, 200_000, 1, 32).select(
            F.when(n % 3 == 0, F.lit(7)).otherwise(n % 30).cast("long").alias("k"), F.xxhash64("id").alias("x")
        )
        lookup_join(facts, names, "k", "left", max_rows=0).write.parquet(str(tmp_path / "out"))
        out = spark.read.parquet(str(tmp_path / "out"))
        tasks = out.where("k = 7").select(F.input_file_name()).distinct().count()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert tasks > 1


# --- fewer facts to shuffle --------------------------------------------------------


def nodes(plan):
    """All nodes of a finished adaptive plan."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from nodes(plan.executedPlan())
        return
    yield name, plan
    if name.endswith("QueryStageExec"):
        yield from nodes(plan.plan())
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def shuffled_rows(frame) -> list[int]:
    """Rows written by each shuffle of the executed frame, largest first."""
    plan = frame._jdf.queryExecution().executedPlan()
    found = {}
    for name, node in nodes(plan):
        if name == "ShuffleExchangeExec":
            found[node.id()] = node.metrics().apply("shuffleRecordsWritten").value()
    return sorted(found.values(), reverse=True)


@pytest.fixture(scope="module")
def large(spark):
    """A session in which no side counts as small."""
    session = tick_session(spark, "UTC", 4)
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    return session


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Many facts of 20,000 keys, some without; the lookup side has every fortieth key."""
    folder = str(tmp_path_factory.mktemp("facts") / "table")
    key = F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") * 7919 % 20_000)
    spark.range(200_000).select(key.alias("k"), "id").write.parquet(folder)
    names = spark.range(0, 20_000, 40).select(F.col("id").alias("k"), F.lit("n").alias("name"))
    return folder, names


@pytest.mark.parametrize("how, falls", [("inner", True), ("left_semi", True), ("left", False), ("left_anti", False)])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_facts_without_a_partner_are_not_shuffled(large, stored, how, falls, kind):
    folder, names = stored
    cast = F.col("k").cast(kind).alias("k")
    facts = large.read.parquet(folder).select(cast, "id")
    got = lookup_join(facts, names.select(cast, "name"), "k", how, max_rows=0)
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("might_contain" in text) == falls
    want = facts.join(names.select(cast, "name"), "k", how)
    assert rows(got) == rows(want, *got.columns)
    matching = facts.join(names.select(cast), "k", "left_semi").count()
    moved = shuffled_rows(got)[0]
    if falls:
        assert matching <= moved <= matching + 0.02 * 200_000
    else:
        assert moved == 200_000


def test_the_filter_is_below_the_exchange(large, stored):
    folder, names = stored
    got = lookup_join(large.read.parquet(folder), names, "k", "inner", max_rows=0)
    text = got._jdf.queryExecution().executedPlan().toString()
    facts_side = text[: text.index("might_contain")]
    assert "Exchange hashpartitioning(k" in facts_side
    # The range of the keys reaches the scan.
    assert "GreaterThanOrEqual(k,0)" in text and "LessThanOrEqual(k,19960)" in text


def test_registered_query_shuffles_what_matches(spark, large, tables):
    got = QUERIES["join_quotes_split"](large, tables)
    assert "might_contain" in got._jdf.queryExecution().optimizedPlan().toString()
    n = len(got.collect())
    facts = spark.read.parquet(f"{tables}/lineitem.parquet").count()
    assert n <= shuffled_rows(got)[0] <= n + 0.02 * facts


def test_an_empty_lookup_side(spark, stored):
    folder, names = stored
    facts = spark.read.parquet(folder)
    for how, n in (("inner", 0), ("left_semi", 0), ("left_anti", 200_000), ("left", 200_000)):
        assert lookup_join(facts, names.where("false"), "k", how, max_rows=-1).count() == n
