"""The continuous tick job.

The windowed aggregate runs in append mode, so each window leaves the state once,
when the watermark has passed its end, and all of its groups leave in the same
micro-batch. The ranking is therefore an ordinary batch query over that
micro-batch: it needs no state of its own, never collects a window into one row,
and gets the same early cut to the top rows as the batch job.

Delivery is exactly-once: a micro-batch that is run again after a failure has the
same rows and replaces the folders of its first attempt.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from tickflow.config import JobConfig
from tickflow.functions.accounting import Account
from tickflow.operators.rank import top_n
from tickflow.plans.ticks import notional_per_window, tick_accounts, top_markets_of_stream
from tickflow.schemas import PARTITIONS
from tickflow.sinks.messages import batch_name
from tickflow.sinks.published import publish_result, result_columns, write_options


class _Totals:
    """Sums over all micro-batches of a query, of which Spark remembers only the last.

    The newest micro-batch stays apart: before it runs, Spark may report its number with
    nothing done yet."""

    def __init__(self):
        self.sums: dict[str, int] = {}
        self.newest, self.of_newest = -1, {}

    def add(self, query, accounts: list[Account]) -> None:
        for progress in query.recentProgress:
            number = progress["batchId"]
            if number > self.newest:
                self.sums, self.newest = self.all(), number
            if number == self.newest:
                dropped = sum(o["numRowsDroppedByWatermark"] for o in progress["stateOperators"])
                counts = [{_LATE: dropped}, *[a.of_progress(progress) for a in accounts]]
                self.of_newest = _added(counts)

    def all(self) -> dict[str, int]:
        return _added([self.sums, self.of_newest])


_LATE = "late"


def _added(counts: list[dict[str, int]]) -> dict[str, int]:
    names = dict.fromkeys(name for c in counts for name in c)
    return {name: sum(c.get(name, 0) for c in counts) for name in names}


# One for every query that this process started, and its accounts.
_totals: dict[str, _Totals] = {}
_accounts: dict[str, list[Account]] = {}


def _publisher(config: JobConfig, queries: list):
    def publish(closed: DataFrame, batch_id: int) -> None:
        result = result_columns(top_n(closed, config.top))
        publish_result(result, config.output, batch_name(closed, batch_id))
        for query in queries:
            before = _totals[query.id].all().get(_LATE, 0) if query.id in _totals else 0
            dropped = late_groups(query) - before
            if dropped:
                print(f"{config.name}: {dropped} groups came after their window was published")

    return publish


def start_job(
    messages: DataFrame | list[DataFrame], config: JobConfig, trigger: dict | None = None
):
    """Start the job on a stream of messages and return the running query.

    Several streams keep their own watermarks (see ``notional_per_window``).
    ``trigger`` overrides the configured interval, e.g. ``{"availableNow": True}``
    to work off what is there and stop.
    """
    accounts = tick_accounts(messages, config)
    notional = notional_per_window(messages, config, accounts)
    config.check(notional.sparkSession)
    queries: list = []
    query = (
        notional.writeStream.queryName(config.name)
        .outputMode("append")
        .foreachBatch(_publisher(config, queries))
        .option("checkpointLocation", config.checkpoint)
        .trigger(**(trigger or {"processingTime": config.trigger}))
        .start()
    )
    _accounts[query.id] = accounts
    queries.append(query)
    return query


def start_chained(
    messages: DataFrame | list[DataFrame],
    config: JobConfig,
    trigger: dict | None = None,
    salts: Iterable[int] = (16,),
):
    """Start the job as one chain of aggregates that ends in Spark's own file sink, in JSON
    by year, month and day; returns the running query.

    The sink keeps a log of its files, so readers see each result once, and a micro-batch
    that is run again adds nothing. It leaves no markers in the days. A folder is either
    written this way or by ``start_job``. Another sink takes ``top_markets_of_stream``.
    """
    result = top_markets_of_stream(messages, config, salts)
    config.check(result.sparkSession)
    return (
        write_options(result.writeStream)
        .queryName(config.name)
        .outputMode("append")
        .format("json")
        .partitionBy(*PARTITIONS.names)
        .option("path", config.output)
        .option("checkpointLocation", config.checkpoint)
        .trigger(**(trigger or {"processingTime": config.trigger}))
        .start()
    )


def run_available(messages: DataFrame | list[DataFrame], config: JobConfig):
    """Work off all messages that are there, then stop; failures are raised."""
    query = start_job(messages, config, {"availableNow": True})
    query.awaitTermination()
    return query


def late_groups(query) -> int:
    """What was dropped since the query was started because its window had closed.

    Spark drops after it has summed each task's ticks, so the unit is a market of a window
    in one task of one micro-batch, not a tick. Spark remembers only the last micro-batches;
    the job looks after each one, so none is forgotten.
    """
    return _summed(query).get(_LATE, 0)


def decoded_counts(query) -> dict[str, int]:
    """What the job has decoded and what it left out since it was started: messages, those
    skipped, without a usable time, and with an unreadable price, volume or time."""
    return {name: n for name, n in _summed(query).items() if name != _LATE}


def _summed(query) -> dict[str, int]:
    totals = _totals.setdefault(query.id, _Totals())
    totals.add(query, _accounts.get(query.id, []))
    return totals.all()
