"""Words of many texts at once, as numpy arrays, inside Spark's Arrow batches.

Texts stay UTF-8 bytes: every word pattern used here is a set of bytes (all bytes from
0x80 up are on the same side), so no text is ever decoded. A word's hash is a polynomial
of its bytes modulo 2**64, taken from running sums, then mixed; equal words have equal
hashes, and A-Z can be made to count as a-z.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

# Texts are handled in runs of rows of about so many bytes; a longer text alone.
CHUNK = 1 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BASE_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64))
_GRAM = np.uint64(0xA0761D6478BD642F)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass(frozen=True)
class Alphabet:
    """Which bytes make words, and the value of each in a hash."""

    in_word: np.ndarray
    value: np.ndarray

    @staticmethod
    def of(in_word: Callable[[int], bool], lower: bool) -> Alphabet:
        value = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
        if lower:
            value[65:91] = value[97:123]
        return Alphabet(np.array([in_word(b) for b in range(256)]), value)


def _spaced(byte: int) -> bool:
    return byte != 0x20 and not 0x09 <= byte <= 0x0D


# ``[^\x20\x09-\x0D]+`` as it is, and in lower case.
PLAIN = Alphabet.of(_spaced, lower=False)
LOWER = Alphabet.of(_spaced, lower=True)
# ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the text in lower case.
LETTERS = Alphabet.of(
    lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or 0x41 <= b <= 0x5A, lower=True
)


class _Powers:
    """Powers of the base and of its inverse, as far as a chunk needs them."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> _Powers:
        if n > len(self.up):
            size = max(n, CHUNK)
            for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                powers = np.full(size, base, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))
        return self


POWERS = _Powers()


@dataclass
class Tokens:
    """The words of some rows. Word i has the bytes start[i] to end[i] of ``data`` and the
    hash hash[i]; the words of row r are bounds[r] to bounds[r + 1]."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def rows(self) -> np.ndarray:
        """The row of every word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of k words within a row, and the word each starts at."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        total = self.hash[:n].copy()
        for i in range(1, k):
            total *= _GRAM
            total += self.hash[i : i + n]
        row = self.rows()
        inside = np.flatnonzero(row[:n] == row[k - 1 :])
        return mix(total[inside]), inside


def tokens(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> Tokens:
    """The words of the rows ``data[offsets[r]:offsets[r + 1]]``; offsets start at 0."""
    n = len(data)
    inside = alphabet.in_word[data]
    begins, ends = inside.copy(), inside.copy()
    if n:
        cuts = offsets[(offsets > 0) & (offsets < n)]
        before, after = np.empty(n, bool), np.empty(n, bool)
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        before[cuts] = False
        after[cuts - 1] = False
        begins &= ~before
        ends &= ~after
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    powers = POWERS.upto(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(alphabet.value[data] * powers.up[:n], out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * powers.down[start])
    return Tokens(data, offsets, start, end, np.searchsorted(start, offsets), hashes)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of an Arrow string array; nulls are empty."""
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if offsets is None or len(texts) == 0:
        return np.zeros(len(texts) + 1, np.int64), np.empty(0, np.uint8)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)


def chunks(
    texts: pa.Array, size: int = CHUNK, rows: int = CHUNK
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """At most ``rows`` consecutive rows of about ``size`` bytes: first row, bytes, offsets
    from 0."""
    offsets, data = buffers(texts)
    row, n = 0, len(texts)
    while row < n:
        upto = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        upto = min(max(upto, row + 1), row + rows, n)
        yield row, data[offsets[row] : offsets[upto]], offsets[row : upto + 1] - offsets[row]
        row = upto


def token_chunks(texts: pa.Array, alphabet: Alphabet) -> Iterator[tuple[int, Tokens]]:
    for row, data, offsets in chunks(texts):
        yield row, tokens(data, offsets, alphabet)


Work = Callable[[pa.RecordBatch], list[pa.Array]]


def over_batches(frame: DataFrame, make: Callable[[], Work], carry: list[str], fields: str) -> DataFrame:
    """``frame``'s columns ``carry`` and new ones: a row for a row. ``make()`` gives, once
    per task, the function from an Arrow batch of ``frame`` to the new columns."""
    new = T._parse_datatype_string(fields)
    schema = T.StructType([*[frame.schema[c] for c in carry], *new.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            columns = [batch.column(c) for c in carry]
            yield pa.RecordBatch.from_arrays([*columns, *work(batch)], schema.names)

    return frame.mapInArrow(run, schema)


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc``, a struct of the given columns (all of them by default), and the text."""
    return docs.select(
        F.struct(*(columns or ("*",))).alias("doc"), F.col("text").cast("string").alias("text")
    )
