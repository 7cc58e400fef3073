"""Ranking inside windows: all rows, or the first few of each window."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickflow.operators.notional import VALUE
from tickflow.scratch import new_folder

WINDOW = ("window_start", "window_end")
TIES = ("market", "name")
_CUT_UP_TO = "spark.sql.optimizer.windowGroupLimitThreshold"


def top_n(
    rows: DataFrame,
    n: int = 5,
    value: str = VALUE,
    ties: Iterable[str] = TIES,
    group: Iterable[str] = WINDOW,
) -> DataFrame:
    """The ``n`` largest rows of each window with their rank ``row_num``.

    The rank filter is what lets Spark cut every task's share of a window to ``n``
    rows before the shuffle, so a crowded window moves ``n`` rows per task. It does so up
    to a setting of Spark's; for more rows all are ranked by ``rank_all``, which sorts no
    window in one task. Equal values are ordered by ``ties``; null values come last.
    """
    if n > int(rows.sparkSession.conf.get(_CUT_UP_TO)):
        return rank_all(rows, value, ties, group).where(F.col("row_num") <= n)
    order = Window.partitionBy(*group).orderBy(F.desc_nulls_last(value), *ties)
    ranked = rows.select("*", F.row_number().over(order).cast("bigint").alias("row_num"))
    return ranked.where(F.col("row_num") <= n)


def rank_all(
    rows: DataFrame,
    value: str = VALUE,
    ties: Iterable[str] = TIES,
    group: Iterable[str] = WINDOW,
) -> DataFrame:
    """Every row with its rank ``row_num`` inside its window.

    A window may hold most of the rows, so it is not sorted in one task: the rows
    are range-partitioned on the whole order, each slice numbers its rows, and a
    slice's numbers are moved up by the row counts of the slices before it. There
    is one offset row per slice and window. ``ties`` must make rows of a window
    distinct and ``group`` must not be null.
    """
    group = list(group)
    order = [*group, F.desc_nulls_last(value), *ties]
    spark = rows.sparkSession
    # Written out once, because slice bounds are sampled: both uses below must see
    # the same slices, also after an executor was lost.
    folder = new_folder(spark, "ranked")
    placed = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "*",
            F.spark_partition_id().alias("_slice"),
            F.monotonically_increasing_id().alias("_at"),
        )
    )
    placed.write.parquet(folder)
    placed = spark.read.schema(placed.schema).parquet(folder)
    earlier = (
        Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    slices = placed.groupBy(*group, "_slice").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    offsets = slices.select(
        *group,
        "_slice",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    numbered = placed.join(offsets, [*group, "_slice"])
    return numbered.select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("row_num"))


def _first_rows(columns: list[str], n: int, value: str, ties: list[str]) -> Column:
    """The ``n`` first rows of a group in the order of ``top_n``, as an array; an aggregate."""
    order = F.struct(
        F.col(value).isNull().alias("none"),
        # Not a number is the largest value there is, also for ``top_n``.
        (~F.isnan(value)).alias("number"),
        (-F.col(value)).alias("size"),
        *[F.col(t).alias(f"tie{i}") for i, t in enumerate(ties)],
        F.struct(*columns).alias("row"),
    )
    first = F.slice(F.array_sort(F.collect_list(order)), 1, n)
    return F.transform(first, lambda r: r.row)


def top_n_of_stream(
    groups: DataFrame,
    n: int = 5,
    value: str = VALUE,
    ties: Iterable[str] = TIES,
    salts: Iterable[int] = (16,),
) -> DataFrame:
    """``top_n`` as a stream: the ``n`` largest rows of every closed window with their rank.

    ``groups`` come from a windowed aggregate in append mode, with its ``window``. What comes
    out is a stream again, for any sink, and holds final results only. It takes one more
    stateful aggregate, which would gather a whole window into one row; so each of ``salts``
    cuts it down first: the rows left are dealt by a hash of ``ties`` over so many shares of
    the window, and every share keeps ``n``. With shares for all but a few thousand rows,
    e.g. ``(4096, 64)`` for windows of ten million groups, no row of state holds more than
    that. Works on tables as well.
    """
    ties = list(ties)
    columns = [c for c in groups.columns if c != "window"]
    for number in salts:
        share = F.pmod(F.xxhash64(*ties), F.lit(number)).alias("_share")
        cut = groups.groupBy("window", share).agg(_first_rows(columns, n, value, ties).alias("_rows"))
        groups = cut.select("window", F.inline("_rows"))
    first = groups.groupBy("window").agg(_first_rows(columns, n, value, ties).alias("_rows"))
    ranked = first.select("window", F.posexplode("_rows").alias("_at", "_row"))
    return ranked.select("window", "_row.*", (F.col("_at") + 1).cast("bigint").alias("row_num"))
