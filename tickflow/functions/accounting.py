"""What the decoder left out, counted in the pass that decodes.

Spark's observed metrics ride along with the rows: the counts are complete when the action
is, cost one sum per task, and add no scan, shuffle or job. On a stream they come with the
progress of each micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import StringType, StructField

from tickflow.functions.scalar import event_time

MESSAGES, DECODED, SKIPPED, UNDATED = "messages", "decoded", "skipped", "undated"
_UNREADABLE = "unreadable_"


def unreadable(field: str) -> str:
    """Under which name a field's values that are no such thing are counted."""
    return f"{_UNREADABLE}{field}"


class Account:
    """Counts of one decoder. Give it to ``decode_json`` or ``decode_ticks``; a table's
    account serves one of them and one action.

    ``messages`` came in, ``decoded`` went out, and the others were ``skipped`` because they
    are no JSON objects. Of the decoded ones, ``undated`` have no usable time and
    ``unreadable_FIELD`` have something in a number's field that is no number."""

    def __init__(self, name: str, time: str | None = None):
        self.name, self.time = name, time
        self._observed: list[Observation] = []

    def _watch(self, frame: DataFrame, part: str, *counts: Column) -> DataFrame:
        name = f"{self.name}-{part}"
        if frame.isStreaming:
            return frame.observe(name, *counts)
        observation = Observation(name)
        self._observed.append(observation)
        return frame.observe(observation, *counts)

    def read(self, messages: DataFrame) -> DataFrame:
        """``messages``, counted."""
        return self._watch(messages, "read", F.count(F.lit(1)).alias(MESSAGES))

    def parsed(self, rows: DataFrame, fields: Iterable[StructField], corrupt: str) -> DataFrame:
        """``rows`` with all fields as text, counted by what will become of them."""
        good = F.col(corrupt).isNull()
        counts = [F.count_if(good).alias(DECODED)]
        for f in fields:
            number = F.col(f.name).try_cast(f.dataType)
            if not isinstance(f.dataType, StringType):
                lost = good & F.col(f.name).isNotNull() & number.isNull()
                counts.append(F.count_if(lost).alias(unreadable(f.name)))
            if f.name == self.time:
                counts.append(F.count_if(good & event_time(number).isNull()).alias(UNDATED))
        return self._watch(rows, "parsed", *counts)

    def counts(self) -> dict[str, int]:
        """The counts of a table, once an action on the decoded rows is over.

        Where Spark finds half-way that a result will be empty it drops the rest of the plan,
        and the counts with it; ``TICK_SETTINGS`` keep it from that."""
        return _put_together([o.get for o in self._observed])

    def of_progress(self, progress) -> dict[str, int]:
        """The counts of one micro-batch, from the query's progress; empty if it had none."""
        observed = progress["observedMetrics"]
        parts = [observed[f"{self.name}-{p}"] for p in ("read", "parsed") if f"{self.name}-{p}" in observed]
        return _put_together([row if isinstance(row, dict) else row.asDict() for row in parts])


def _put_together(parts: list[dict]) -> dict[str, int]:
    counts = {name: n or 0 for part in parts for name, n in part.items()}
    if MESSAGES in counts and DECODED in counts:
        counts[SKIPPED] = counts[MESSAGES] - counts[DECODED]
    return counts
