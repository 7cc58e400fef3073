"""Vectors as short codes: product quantisation by integer Lloyd rounds, exact and repeatable.

Components become integers, ``floor(scale * x)``, and a vector is cut into ``parts``
consecutive parts. Every part position has a codebook, which starts as that part of the
first vectors by id. A round assigns every part to the nearest entry of its codebook
(squared Euclidean distance, ties to the lower index) and then moves every entry to the
componentwise ``floor(sum / count)`` of its parts; an entry without parts stays. After the
last round the parts are assigned once more.

Assignment looks at active entries only. The entry and the exact distance of every part are
kept from one round to the next. Where a part's entry has not moved, that distance still
holds, and no other entry that has not moved can beat it: only moved entries are compared
with it. Where a part's entry has moved, the whole codebook is. When nothing has moved, all
later rounds would change nothing and are left out.

A round is one pass over the vectors, written to the shared folder with their entries and
distances, and one row of sums and counts from each task; only codebooks pass through the
driver. Vectors are never shuffled: a label's sum is combined in the tasks and joined back.

Rows whose vector is null or holds null or non-finite components are left out. So are rows
whose vector has another length than the first one by id. A length that ``parts`` does not
divide is cut as evenly as can be. Components beyond ``LARGEST`` count as ``LARGEST``,
which keeps squared distances inside 64 bits. Rows without an id come last where ids decide;
equal ids are ordered by their vectors; repeated rows count each. Fewer vectors than entries
give smaller codebooks, and an empty table an empty result. Only the columns named are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickflow.scratch import new_folder

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
# In integer units: 8 parts of 8 components that are twice this far apart fit in 2**62.
LARGEST = 1 << 27

_STATE = "vec_id long, label {label}, units binary, code binary, distance binary"


@dataclass(frozen=True)
class Cuts:
    """Where the parts of a vector begin and end."""

    size: int
    parts: int

    def __iter__(self) -> Iterator[slice]:
        for i in range(self.parts):
            yield slice(i * self.size // self.parts, (i + 1) * self.size // self.parts)


Codebooks = list[np.ndarray]  # per part: entries by components


def _units(vectors: DataFrame, vector: str, scale: int) -> DataFrame:
    """vec_id, label and the integer components of the rows that count."""
    values = F.col(vector).cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(
        values, lambda x: F.floor(F.least(F.greatest(x * scale, F.lit(-float(LARGEST))), F.lit(float(LARGEST))))
    )
    kept = vectors.where(F.col(vector).isNotNull() & ~bad)
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), "label", whole.cast("array<int>").alias("units"))


def _first(units: DataFrame, n: int) -> list[list[int]]:
    """The ``n`` first vectors by id."""
    order = [F.asc_nulls_last("vec_id"), "units"]
    size = F.size("units")
    first = units.orderBy(*order).limit(1).select("units").collect()
    if not first:
        return []
    same = units.where(size == len(first[0].units))
    return [r.units for r in same.orderBy(*order).limit(n).select("units").collect()]


def assign(
    units: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray | None, distance: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every part (rows of ``units``) and its squared distance.

    ``code`` and ``distance`` are those of the round before and ``moved`` tells which entries
    are no longer where they were then; without them everything is compared."""

    def scan(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        apart = rows[:, None, :] - book[None, entries, :]
        square = np.einsum("ijk,ijk->ij", apart, apart)
        nearest = square.argmin(axis=1)  # the first of equal ones
        return entries[nearest], square[np.arange(len(rows)), nearest]

    every = np.arange(len(book))
    if code is None or distance is None:
        return scan(units, every)
    code, distance = code.copy(), distance.copy()
    astray = np.flatnonzero(moved[code])
    settled = np.flatnonzero(~moved[code])
    if len(astray):
        code[astray], distance[astray] = scan(units[astray], every)
    active = np.flatnonzero(moved)
    if len(active) and len(settled):
        entry, square = scan(units[settled], active)
        nearer = (square < distance[settled]) | ((square == distance[settled]) & (entry < code[settled]))
        changed = settled[nearer]
        code[changed], distance[changed] = entry[nearer], square[nearer]
    return code, distance


def _matrix(column: pa.Array, kind: type, width: int) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, kind).reshape(len(column), width)


def _assigned(state: DataFrame, cuts: Cuts, books: Codebooks, moved: list[np.ndarray], again: bool) -> DataFrame:
    """``state`` with new entries and distances."""
    names = state.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            units = _matrix(batch.column("units"), np.int32, cuts.size).astype(np.int64)
            before = _matrix(batch.column("code"), np.uint8, cuts.parts) if again else None
            held = _matrix(batch.column("distance"), np.int64, cuts.parts) if again else None
            code = np.empty((len(batch), cuts.parts), np.uint8)
            distance = np.empty((len(batch), cuts.parts), np.int64)
            for i, cut in enumerate(cuts):
                code[:, i], distance[:, i] = assign(
                    units[:, cut], books[i], moved[i],
                    None if before is None else before[:, i].astype(np.int64),
                    None if held is None else held[:, i],
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"), batch.column("label"), batch.column("units"),
                    pa.array([c.tobytes() for c in code], pa.binary()),
                    pa.array([d.tobytes() for d in distance], pa.binary()),
                ],
                names,
            )

    return state.mapInArrow(run, state.schema)


def _sums(state: DataFrame, cuts: Cuts, entries: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per part and entry the componentwise sum of its parts, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((entries, cut.stop - cut.start), np.int64) for cut in cuts]
        count = np.zeros((cuts.parts, entries), np.int64)
        for batch in batches:
            if not len(batch):
                continue
            units = _matrix(batch.column("units"), np.int32, cuts.size).astype(np.int64)
            code = _matrix(batch.column("code"), np.uint8, cuts.parts)
            for i, cut in enumerate(cuts):
                np.add.at(total[i], code[:, i], units[:, cut])
                count[i] += np.bincount(code[:, i], minlength=entries)
        rows = [(i, e, count[i, e], total[i][e].tolist()) for i, e in zip(*np.nonzero(count), strict=True)]
        part, entry, n, sums = zip(*rows, strict=True) if rows else ((),) * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n, pa.int64()),
             pa.array(sums, pa.list_(pa.int64()))],
            ["part", "entry", "n", "sums"],
        )

    own = state.select("units", "code").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    # One row per entry and component: partial sums in the tasks, then 1 row per entry each.
    width = max(cut.stop - cut.start for cut in cuts)
    components = [F.sum(F.get("sums", F.lit(j))).alias(f"s{j}") for j in range(width)]
    found = own.groupBy("part", "entry").agg(F.sum("n").alias("n"), *components).collect()
    total = [np.zeros((entries, cut.stop - cut.start), np.int64) for cut in cuts]
    count = [np.zeros(entries, np.int64) for _ in cuts]
    for row in found:
        count[row.part][row.entry] = row.n
        total[row.part][row.entry] = [row[f"s{j}"] for j in range(total[row.part].shape[1])]
    return total, count


def _moved(books: Codebooks, total: list[np.ndarray], count: list[np.ndarray]) -> tuple[Codebooks, list[np.ndarray]]:
    """The next codebooks, and which of their entries are new."""
    after = []
    for book, sums, n in zip(books, total, count, strict=True):
        means = sums // np.maximum(n, 1)[:, None]  # rounds down
        after.append(np.where((n > 0)[:, None], means, book))
    return after, [(a != b).any(axis=1) for a, b in zip(after, books, strict=True)]


def _written(frame: DataFrame) -> DataFrame:
    path = new_folder(frame.sparkSession, "vector-codes")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def encode(
    vectors: DataFrame,
    vector: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    progress: Callable[[int, list[np.ndarray]], None] | None = None,
) -> tuple[DataFrame, Codebooks]:
    """vec_id, label, ``code`` (binary, one byte per part) and ``error`` (the squared
    distances summed) of every row that counts, and the final codebooks.

    ``entries`` is at most 256. ``progress`` is told each round and what moved in it."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte per part: 1 to 256 entries")
    units = _written(_units(vectors, vector, scale))
    first = _first(units, entries)
    spark, label = vectors.sparkSession, vectors.schema["label"].dataType.simpleString()
    if not first:
        nothing = spark.createDataFrame([], f"vec_id long, label {label}, code binary, error long")
        return nothing, [np.zeros((0, 0), np.int64)] * parts
    cuts = Cuts(len(first[0]), parts)
    books = [np.array(first, np.int64)[:, cut] for cut in cuts]
    packed = _packed(units.where(F.size("units") == cuts.size), label)
    still = [np.zeros(len(first), bool)] * parts
    state = _written(_assigned(packed, cuts, books, still, again=False))
    for done in range(1, rounds + 1):
        books, moved = _moved(books, *_sums(state, cuts, len(first)))
        if progress:
            progress(done, moved)
        if not any(m.any() for m in moved):
            break
        state = _written(_assigned(state, cuts, books, moved, again=True))
    errors = _errors(state, cuts, label)
    return errors, books


def _packed(units: DataFrame, label: str) -> DataFrame:
    """The state before the first round: integer components as bytes, nothing assigned."""
    schema = _STATE.format(label=label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("units")
            flat, n = column.flatten().to_numpy().astype(np.int32), len(batch)
            rows = flat.reshape(n, -1) if n else flat.reshape(0, 0)
            nothing = pa.nulls(n, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([r.tobytes() for r in rows], pa.binary()),
                 nothing, nothing],
                ["vec_id", "label", "units", "code", "distance"],
            )

    return units.mapInArrow(run, schema)


def _errors(state: DataFrame, cuts: Cuts, label: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                error = _matrix(batch.column("distance"), np.int64, cuts.parts).sum(axis=1)
                columns = [batch.column(c) for c in ("vec_id", "label", "code")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(error)], ["vec_id", "label", "code", "error"])

    wanted = state.select("vec_id", "label", "code", "distance")
    return wanted.mapInArrow(run, f"vec_id long, label {label}, code binary, error long")


def fingerprint(books: Codebooks) -> str:
    """SHA-256 of all components by part, entry and position, as decimals with commas."""
    text = ",".join(str(int(x)) for book in books for entry in book for x in entry)
    return hashlib.sha256(text.encode()).hexdigest()


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` and ``label_error``, the errors of all rows of the same label summed."""
    sums = _written(codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("label_error")))
    sums = sums.select(F.col("label").alias("_label"), F.expr("try_cast(label_error as long)").alias("label_error"))
    return codes.join(sums, codes.label.eqNullSafe(sums["_label"])).drop("_label")
