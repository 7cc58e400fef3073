"""Benchmark decontamination by a generalised suffix automaton of the test items.

Texts and items are lower-cased (A-Z) and cut into words. All items go into one automaton
that accepts every run of words of any item. Training words are streamed through it: it
holds the longest run ending at the current word that some item contains. Where that run
is at least ``window`` words long, those words are a contaminated span; an item with fewer
words counts where it occurs whole. Each state knows the windows that end in it and their
items, so no item is searched for on its own.

Most training words need not be streamed: a run of ``window`` item words consists of word
pairs of items, so only stretches of such pairs, found with a bit table on whole columns,
go through the automaton.

Items are given to the workers in automata of at most about ``shard_words`` words each,
counted before they are built, one pass over the documents per automaton; the passes are
chained in place, without a shuffle. Documents are never grouped or collected, so copies
and hot sources cost no more than other rows.

Null and empty texts have no words and stay clean; items without words are ignored; an
item without an id is listed as the empty string. Repeated items are listed once per id,
repeated documents are handled alike, and an empty table on either side gives clean
documents or no rows. All columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickflow.llm.words import LETTERS, Tokens, Work, mix, over_batches, packed, token_chunks

# Bits of the tables that tell item word pairs and item words at a glance.
BITS = 22


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _pairs(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes[:-1] * np.uint64(3) + hashes[1:])


@dataclass
class Automaton:
    """Suffix automaton of several word sequences. State 0 accepts nothing but ``()``;
    state s accepts runs of more than length[link[s]] and at most length[s] words."""

    window: int
    next: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    # What ends in a state: (words, items), and the nearest state up the links with any.
    ends: dict[int, list[tuple[int, frozenset[str]]]] = field(default_factory=dict)
    above: list[int] = field(default_factory=list)

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A copy of ``target`` for the shorter runs that ``state`` + ``word`` ends."""
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state != -1 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        target = self.next[last].get(word)
        if target is not None:
            # An earlier item has this run already.
            if self.length[target] == self.length[last] + 1:
                return target
            return self._split(last, word, target)
        new = self._state(self.length[last] + 1, 0, {})
        state = last
        while state != -1 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state != -1:
            target = self.next[state][word]
            fits = self.length[target] == self.length[state] + 1
            self.link[new] = target if fits else self._split(state, word, target)
        return new

    def build(self, items: list[tuple[str, list[int]]]) -> Automaton:
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        found: dict[tuple[int, int], set[str]] = {}
        for item, words in items:
            size = min(self.window, len(words))
            state = 0
            for i, word in enumerate(words):
                state = self.next[state][word]
                if i + 1 >= size:
                    at = state
                    while self.length[self.link[at]] >= size:
                        at = self.link[at]
                    found.setdefault((at, size), set()).add(item)
        for (state, size), names in found.items():
            self.ends.setdefault(state, []).append((size, frozenset(names)))
        # Links lead to shorter runs, so states by length come after what they link to.
        self.above = [0] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up = self.link[state]
            self.above[state] = up if up in self.ends else self.above[up]
        return self

    def matches(self, words: list[int]):
        """Yields (index of the last word, longest window in words, items' sets)."""
        following, link, length, ends, above = self.next, self.link, self.length, self.ends, self.above
        state, run = 0, 0
        for i, word in enumerate(words):
            target = following[state].get(word)
            while target is None and state:
                state = link[state]
                run = length[state]
                target = following[state].get(word)
            if target is None:
                continue
            state, run = target, run + 1
            at = state if state in ends else above[state]
            longest, sets = 0, []
            while at:
                for size, names in ends[at]:
                    if size <= run:
                        longest = max(longest, size)
                        sets.append(names)
                at = above[at]
            if longest:
                yield i, longest, sets


@dataclass
class Scanner:
    """An automaton with the vocabulary and the bit tables of its items."""

    window: int
    automaton: Automaton
    vocabulary: np.ndarray
    shortest: int
    words: np.ndarray
    pairs: np.ndarray

    @staticmethod
    def of(ids: list[str], texts: pa.Array, window: int) -> Scanner:
        hashes, names = [], []
        for row, found in token_chunks(texts, LETTERS):
            for r, (a, b) in enumerate(zip(found.bounds[:-1], found.bounds[1:], strict=True)):
                if b > a:
                    hashes.append(found.hash[a:b])
                    names.append(ids[row + r])
        everything = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        vocabulary = np.unique(everything)
        items = [
            (name, np.searchsorted(vocabulary, h).tolist())
            for name, h in zip(names, hashes, strict=True)
        ]
        known, pairs = np.zeros(1 << BITS, bool), np.zeros(1 << BITS, bool)
        known[_slot(vocabulary)] = True
        for h in hashes:
            pairs[_slot(_pairs(h))] = True
        shortest = min([window, *[len(h) for h in hashes]])
        return Scanner(window, Automaton(window).build(items), vocabulary, shortest, known, pairs)

    def scan(self, found: Tokens, hit: np.ndarray, note: Callable[[int, frozenset[str]], None]) -> None:
        """Mark the words in occurring windows in ``hit``; ``note(row, items)`` gets what occurs."""
        n = len(found.hash)
        if not n or not len(self.vocabulary):
            return
        row = found.rows()
        # joined[i]: word i and the next may be neighbours in an item.
        joined = np.zeros(n + 1, bool)
        joined[1:n] = self.pairs[_slot(_pairs(found.hash))] & (row[:-1] == row[1:])
        first = np.flatnonzero(~joined[:-1] & joined[1:])
        last = np.flatnonzero(joined[:-1] & ~joined[1:])
        if self.shortest == 1:
            # Words of one-word items may stand alone.
            alone = np.flatnonzero(~joined[:-1] & ~joined[1:] & self.words[_slot(found.hash)])
            first, last = np.concatenate([first, alone]), np.concatenate([last, alone])
        long = last - first + 1 >= self.shortest
        unknown = len(self.vocabulary)
        for a, b in zip(first[long].tolist(), last[long].tolist(), strict=True):
            h = found.hash[a : b + 1]
            at = np.searchsorted(self.vocabulary, h)
            at[at == unknown] = 0
            words = np.where(self.vocabulary[at] == h, at, -1).tolist()
            for i, size, sets in self.automaton.matches(words):
                hit[a + i - size + 1 : a + i + 1] = True
                for names in sets:
                    note(row[a], names)


SPANS = "spans array<struct<first: bigint, last: bigint>>"


def _runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _scan_batch(scanner: Scanner, batch: pa.RecordBatch, cut: bool) -> list[pa.Array]:
    names = batch.schema.names
    before = batch.column("spans").to_pylist() if "spans" in names else None
    items = [set(x) for x in batch.column("items").to_pylist()] if before else [set() for _ in range(len(batch))]
    n_words, n_hit, spans, texts = [], [], [], []
    for row, found in token_chunks(batch.column("text"), LETTERS):
        hit = np.zeros(len(found.hash), bool)
        if before:
            for r in range(len(found.bounds) - 1):
                for s in before[row + r]:
                    hit[found.bounds[r] + s["first"] : found.bounds[r] + s["last"]] = True
        scanner.scan(found, hit, lambda r, names, row=row: items[row + r].update(names))
        for r in range(len(found.bounds) - 1):
            a, b = found.bounds[r], found.bounds[r + 1]
            first, last = _runs(hit[a:b])
            n_words.append(int(b - a))
            n_hit.append(int((last - first).sum()))
            spans.append([{"first": x, "last": y} for x, y in zip(first.tolist(), last.tolist(), strict=True)])
            if cut:
                whole = found.data[found.offsets[r] : found.offsets[r + 1]]
                keep = np.ones(len(whole), bool)
                for x, y in zip(first, last, strict=True):
                    keep[found.start[a + x] - found.offsets[r] : found.end[a + y - 1] - found.offsets[r]] = False
                texts.append(whole[keep].tobytes().decode("utf-8"))
    span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    out = [
        pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
        pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(spans, span),
    ]
    return [*out, pa.array(texts, pa.string())] if cut else out


def scan(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, cut: bool = False,
    shard_words: int = 1_000_000, columns: tuple[str, ...] = (),
) -> DataFrame:
    """For every row of ``docs``: ``doc`` (its ``columns``, all by default), ``n_words``,
    ``n_hit``, ``items`` (ids, sorted), ``spans`` (word ranges [first, last)), and with
    ``cut`` also ``clean``, the text without the spans."""
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # in capitals too
    total = items.agg(F.sum(F.regexp_count("text", F.lit(word)))).first()[0]
    shards = max(1, -(-(total or 0) // shard_words))
    items = items.withColumn("shard", F.pmod(F.xxhash64("item", "text"), F.lit(shards)))
    result = packed(docs, *columns)
    fields = f"n_words bigint, n_hit bigint, items array<string>, {SPANS}"
    for shard in range(shards):
        held = items.where(F.col("shard") == shard).select("item", "text").toArrow().combine_chunks()
        texts = held.column("text").combine_chunks() if len(held) else pa.array([], pa.string())
        scanner = spark.sparkContext.broadcast(Scanner.of(held.column("item").to_pylist(), texts, window))
        final = shard == shards - 1
        carry = ["doc"] if final else ["doc", "text"]

        def make(scanner=scanner, cut=cut and final) -> Work:
            return lambda batch: _scan_batch(scanner.value, batch, cut)

        result = over_batches(result, make, carry, fields + (", clean string" if cut and final else ""))
    return result


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5
) -> DataFrame:
    """``docs`` with the same columns, without contaminated spans. A document with more
    than ``max_coverage`` of its words in spans goes altogether. ``n_chars`` follows the
    text if there is such a column."""
    found = scan(docs, benchmark, window, cut=True)
    doc, touched = F.col("doc"), F.col("n_hit") > 0
    new = {"text": F.col("clean"), "n_chars": F.char_length("clean")}
    columns = [
        F.when(touched, new[c].cast(docs.schema[c].dataType)).otherwise(doc[c]).alias(c)
        if c in new else doc[c].alias(c)
        for c in docs.columns
    ]
    return found.where(F.col("n_hit") <= max_coverage * F.col("n_words")).select(*columns)
