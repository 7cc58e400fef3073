"""Quality classifier: support vectors on naive Bayes features.

A text's features are indicators: the byte 4-grams it contains, hashed into ``2**BITS``
slots, and one indicator for how much of it lies in repeated 3-word runs (in steps).

1. Over all labelled texts that may be learned from, Spark counts in how many of each
   class a feature occurs; its log-count ratio r scales its indicator. The counts are
   summed per task first, so what is shuffled is at most a row per slot and task.
2. A linear hinge-loss model is fitted on the scaled features, brought to length 1, by
   dual coordinate descent: one text at a time, its dual variable is set to the best value
   in [0, C]. This runs over a sample of about ``sample_rows`` of those texts, chosen by a
   hash of their ids; the bound is the only thing that does not grow with the data.
3. A logistic curve over the sample's margins makes them probabilities.

Scoring is one pass over the documents with the model (two arrays of ``2**BITS`` numbers)
in every worker, without a shuffle.

Null and empty texts have the indicator of no repetition only and get a score like any
other. If one class has no labelled text, scores are constant: 1 or 0 for the class there
is, and 0.5 without labels. Repeated rows are scored alike; an empty table gives no rows.
All columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickflow.llm import logistic
from tickflow.llm.labels import labelled, sample
from tickflow.llm.words import PLAIN, chunks, over_batches, packed, tokens

BITS = 18
REPEATED = np.array([0.0, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8])
SLOTS = (1 << BITS) + len(REPEATED) + 1
# A row number and a slot share 32 bits.
ROWS = 1 << 13
SHIFT = np.uint32(19)


def features(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bounds and slots: those of row r are slots[bounds[r]:bounds[r + 1]]."""
    for row, data, offsets in chunks(texts, rows=ROWS):
        n = len(offsets) - 1
        lengths = np.diff(offsets)
        keys = [np.empty(0, np.uint32)]
        rows = np.repeat(np.arange(n, dtype=np.uint32), lengths)
        if len(data) > 3:
            b = data.astype(np.uint32)
            gram = (b[:-3] << np.uint32(24)) | (b[1:-2] << np.uint32(16)) | (b[2:-1] << np.uint32(8)) | b[3:]
            gram *= np.uint32(2654435769)
            gram >>= np.uint32(32 - BITS)
            gram |= rows[:-3] << SHIFT
            keys.append(gram[rows[:-3] == rows[3:]])
        found = tokens(data, offsets, PLAIN)
        runs, start = found.grams(3)
        at = found.rows()[start]
        distinct = np.sort((at.astype(np.uint64) << np.uint64(44)) | (runs >> np.uint64(20)))
        if len(distinct):
            distinct = distinct[np.concatenate([[True], distinct[1:] != distinct[:-1]])]
        total = np.bincount(at, minlength=n)
        once = np.bincount((distinct >> np.uint64(44)).astype(np.int64), minlength=n)
        step = np.searchsorted(REPEATED, (total - once) / np.maximum(total, 1))
        keys.append((np.arange(n, dtype=np.uint32) << SHIFT) | ((1 << BITS) + step).astype(np.uint32))
        every = np.concatenate(keys)
        every.sort()
        every = every[np.concatenate([[True], every[1:] != every[:-1]])]
        bounds = np.searchsorted(every, np.arange(n + 1, dtype=np.uint64) << np.uint64(SHIFT))
        yield row, bounds, (every & np.uint32((1 << 19) - 1)).astype(np.int32)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's texts per class and slot; slot -1 counts the texts."""
    seen = np.zeros((2, SLOTS), np.int64)
    texts = np.zeros(2, np.int64)
    for batch in batches:
        label = batch.column("label").to_numpy() > 0
        for row, bounds, slots in features(batch.column("text")):
            n = len(bounds) - 1
            of = np.repeat(label[row : row + n], np.diff(bounds))
            for c in (0, 1):
                seen[c] += np.bincount(slots[of == bool(c)], minlength=SLOTS)
                texts[c] += int((label[row : row + n] == bool(c)).sum())
    some = np.flatnonzero(seen.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([[-1], some]), pa.int32()),
            pa.array(np.concatenate([texts[:1], seen[0, some]])),
            pa.array(np.concatenate([texts[1:], seen[1, some]])),
        ],
        ["slot", "bad", "good"],
    )


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slots = [
            found[a:b].tobytes()
            for _, bounds, found in features(batch.column("text"))
            for a, b in zip(bounds[:-1], bounds[1:], strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(slots, pa.binary())],
            ["doc_id", "label", "slots"],
        )


@dataclass
class Model:
    """Ratios r, weights w, intercept b, and the logistic curve over margins."""

    ratio: np.ndarray
    weight: np.ndarray
    intercept: float
    curve: np.ndarray

    def margins(self, bounds: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """The model's margin of every row; every row has at least one feature."""
        r = self.ratio[slots]
        length = np.sqrt(np.add.reduceat(r * r, bounds[:-1]))
        return np.add.reduceat(r * self.weight[slots], bounds[:-1]) / np.maximum(length, 1e-9) + self.intercept

    def scores(self, texts: pa.Array) -> np.ndarray:
        parts = [
            logistic.probability(self.margins(bounds, slots)[:, None], self.curve)
            for _, bounds, slots in features(texts)
        ]
        return np.concatenate(parts) if parts else np.empty(0)


def descend(
    vectors: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, c: float, rounds: int, slots: int
) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss: weights and intercept (an extra feature
    of value 1). Stops when no dual variable can move, or after ``rounds`` rounds."""
    weight, intercept = np.zeros(slots), 0.0
    dual = np.zeros(len(vectors))
    diagonal = np.array([x @ x + 1 for _, x in vectors])
    order = np.random.default_rng(0)
    for _ in range(rounds):
        furthest = 0.0
        for i in order.permutation(len(vectors)):
            at, x = vectors[i]
            slope = signs[i] * (weight[at] @ x + intercept) - 1
            moved = min(max(dual[i] - slope / diagonal[i], 0.0), c) - dual[i]
            if moved:
                weight[at] += signs[i] * moved * x
                intercept += signs[i] * moved
                dual[i] += moved
                furthest = max(furthest, abs(moved))
        if furthest < 1e-4:
            break
    return weight, intercept


def train(
    docs: DataFrame, labels: DataFrame, held_out: Column, column: str = "quality",
    sample_rows: int = 4000, c: float = 1.0, rounds: int = 30,
) -> Model:
    """Learn from the documents whose labels are not ``held_out`` (a condition on doc_id)."""
    rows, n = labelled(docs, labels, column, held_out)
    counted = (
        rows.select("text", "label").mapInArrow(_count, "slot int, bad long, good long")
        .groupBy("slot").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .toArrow()
    )
    slot = counted.column("slot").to_numpy()
    counts = np.zeros((2, SLOTS + 1))
    counts[:, slot] = counted.column("bad").to_numpy(), counted.column("good").to_numpy()
    texts = counts[:, -1]
    if not texts.all():
        # Nothing to tell apart.
        prior = np.log((texts[1] + 1e-9) / (texts[0] + 1e-9)) if texts.any() else 0.0
        return Model(np.zeros(SLOTS), np.zeros(SLOTS), 0.0, np.array([0.0, prior]))
    share = (counts[:, :-1] + 1) / (texts[:, None] + 2)
    ratio = np.log(share[1] / share[0])

    held = sample(rows, n, sample_rows).mapInArrow(_vectors, "doc_id long, label int, slots binary").toArrow()
    held = held.sort_by([("doc_id", "ascending"), ("slots", "ascending")])
    label = held.column("label").to_numpy() > 0
    vectors = []
    for packed_slots in held.column("slots").to_pylist():
        at = np.frombuffer(packed_slots, np.int32)
        x = ratio[at]
        vectors.append((at, x / max(1e-9, np.sqrt(x @ x))))
    weight, intercept = descend(vectors, np.where(label, 1.0, -1.0), c, rounds, SLOTS)
    margin = np.array([weight[at] @ x + intercept for at, x in vectors])
    return Model(ratio, weight, intercept, logistic.fit(margin[:, None], label.astype(float), ridge=1e-2))


def score(docs: DataFrame, model: Model, columns: tuple[str, ...] = ()) -> DataFrame:
    """``doc`` (the row's ``columns``, all by default) and ``score``, the probability of
    label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return over_batches(
        packed(docs, *columns),
        lambda: lambda batch: [pa.array(shared.value.scores(batch.column("text")), pa.float64())],
        ["doc"], "score double",
    )
