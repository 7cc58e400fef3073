"""How far the sources of a language are apart in their words, exactly.

Terms are runs of letters (A-Z as a-z, and everything beyond ASCII). A language keeps the
terms of at least ``least_docs`` of its documents, V of them. A group (language, source),
and the language as a whole, gives a kept term with c occurrences the price
``p = 1 + floor(UNIT * (c + 2) / (N + 2 V))``, N being its occurrences of all kept terms. Two
prices are ``floor((p - q)^2 / (p + q))`` apart. Sources are compared in pairs over all kept
terms, and with their language term by term.

1. Tasks count their documents' terms and write, per language, source and slice of the
   terms' hashes, sorted arrays of hashes, occurrences and documents, and the spelling of
   each term once. Only arrays are shuffled, so a source with most of the documents sends no
   more than the distinct terms of its tasks.
2. Per language and slice the arrays are merged: terms in too few documents go, the others
   get ids in the order of their spelling. Each source has then one sorted array of (id,
   count) per slice.
3. Pair tasks: two sources' arrays of a slice meet in one row, once for each unordered pair.
   Every id of the shorter array is searched in the longer one, starting from where the one
   before was found. That splits the terms into those of both, of either one, and of none;
   a term that a source lacks has the same price wherever it is lacking, so the terms of
   none are priced together. The slices' sums are added up.
4. Terms: each slice gives its best terms of a source, and the best of those count.

Slices hold about ``slice_bytes`` of text before terms are counted, so no task holds a whole
vocabulary, and none a whole source. All arithmetic is on integers.

Null text, language or source is the empty string; a group without terms is priced like any
other; a language without kept terms has no distances but 0. Equal values are ordered by
the item's UTF-8 bytes. Repeated rows are documents of their own. An empty table gives an
empty result. Only text, lang and source are read. Terms are told apart by 64-bit hashes of
their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickflow.llm.words import Alphabet, Tokens, token_chunks
from tickflow.scratch import new_folder

UNIT_STEPS = 3  # prices count in thousandths of thousandths of thousandths
UNIT = 1000**UNIT_STEPS
LEAST_DOCS = 10
SLICE_BYTES = 64 << 20
# A task sends what it has counted when it holds so many entries (24 bytes each).
HELD = 4_000_000

# ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+`` with A-Z as a-z.
TERMS = Alphabet.of(lambda b: b >= 0x80 or 0x61 <= b <= 0x7A or 0x41 <= b <= 0x5A, lower=True)

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_COUNTED = "lang string, slice long, source string, terms binary, n binary, docs binary, words binary"
_MERGED = "lang string, slice long, source string, ids binary, counts binary, words binary, v long, total long"


# --- counting ----------------------------------------------------------------------


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of sorted keys begins."""
    if not len(keys[0]):
        return np.empty(0, np.int64)
    new = np.zeros(len(keys[0]) - 1, bool)
    for key in keys:
        new |= key[1:] != key[:-1]
    return np.concatenate([[0], np.flatnonzero(new) + 1])


def _merge(group: np.ndarray, term: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Counts of the same group and term added up, sorted by both."""
    order = np.lexsort((term, group))
    group, term = group[order], term[order]
    at = _runs(group, term)
    sums = [np.add.reduceat(c[order], at) if len(at) else c[:0] for c in counts]
    return group[at], term[at], *sums


class _Counter:
    """Occurrences and documents of the terms of a task's documents."""

    def __init__(self, bits: int):
        self.bits = bits
        self.groups: dict[tuple[str, str], int] = {}
        self.clear()

    def clear(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0
        self.spelled: dict[str, np.ndarray] = {}
        self.words: dict[str, list[tuple[np.ndarray, list[bytes]]]] = {}

    def add(self, found: Tokens, langs: list[str], sources: list[str]) -> None:
        keys = list(zip(langs, sources, strict=True))
        of_row = np.array([self.groups.setdefault(k, len(self.groups)) for k in keys], np.int64)
        row = found.rows()
        order = np.argsort(found.hash, kind="stable")  # by term, then by row
        term, row = found.hash[order], row[order]
        at = _runs(term, row)
        n = np.diff(np.append(at, len(term)))
        group = of_row[row[at]]
        merged = _merge(group, term[at], n, np.ones(len(at), np.int64))
        self.parts.append(merged)
        self.held += len(merged[0])
        # Each term is spelled out once for a language.
        lang_of = {lang: i for i, lang in enumerate(dict.fromkeys(langs))}
        lang = np.array([lang_of[k] for k in langs], np.int64)[row[at]]
        for name, i in lang_of.items():
            mine = at[lang == i]
            terms, first = np.unique(term[mine], return_index=True)
            known = self.spelled.get(name, terms[:0])
            new = np.flatnonzero(~_within(terms, known))
            if len(new):
                places = order[mine[first[new]]].tolist()
                raw = found.data
                spelled = [raw[found.start[p] : found.end[p]].tobytes().translate(_LOWER) for p in places]
                self.words.setdefault(name, []).append((terms[new], spelled))
                self.spelled[name] = np.union1d(known, terms[new])

    def rows(self) -> Iterator[pa.RecordBatch]:
        """What was counted, by language, slice and source."""
        if self.parts:
            group, term, n, docs = _merge(*[np.concatenate(x) for x in zip(*self.parts, strict=True)])
            names = {i: k for k, i in self.groups.items()}
            cuts = np.append(_runs(group), len(group))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                lang, source = names[int(group[a])]
                yield self._sliced(lang, source, term[a:b], n[a:b], docs[a:b])
        for lang, found in self.words.items():
            terms = np.concatenate([t for t, _ in found])
            spelled = [w for _, ws in found for w in ws]
            order = np.argsort(terms)
            yield self._sliced(lang, None, terms[order], words=[spelled[i] for i in order.tolist()])
        self.clear()

    def _sliced(self, lang, source, terms, n=None, docs=None, words=None) -> pa.RecordBatch:
        of = _slice(terms, self.bits)
        cuts = np.append(_runs(of), len(of)).tolist()
        spans = list(zip(cuts[:-1], cuts[1:], strict=True))

        def packed(values: np.ndarray | None) -> pa.Array:
            if values is None:
                return pa.nulls(len(spans), pa.binary())
            return pa.array([values[a:b].tobytes() for a, b in spans], pa.binary())

        joined = [b"\n".join(words[a:b]) if words else None for a, b in spans]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(spans), pa.string()), pa.array([int(of[a]) for a, _ in spans], pa.int64()),
                pa.array([source] * len(spans), pa.string()), packed(terms),
                packed(None if n is None else n.astype(np.uint32)),
                packed(None if docs is None else docs.astype(np.uint32)), pa.array(joined, pa.binary()),
            ],
            ["lang", "slice", "source", "terms", "n", "docs", "words"],
        )


def _slice(terms: np.ndarray, bits: int) -> np.ndarray:
    return (terms >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(terms), np.int64)


def _within(values: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)
    return sorted_[at] == values


def _counted(docs: DataFrame, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(bits)
        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            for row, found in token_chunks(batch.column("text"), TERMS):
                upto = row + len(found.bounds) - 1
                counter.add(found, langs[row:upto], sources[row:upto])
                if counter.held > HELD:
                    yield from counter.rows()
        yield from counter.rows()

    return docs.mapInArrow(run, _COUNTED)


def _arrays(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) if x is not None else np.empty(0, kind) for x in column.to_pylist()]


def _merged(least_docs: int):
    """From all counts of a slice of a language to its kept terms: one row per source, and
    one for the language (without a source) that has the words."""

    def run(table: pa.Table) -> pa.Table:
        lang, slice_ = table.column("lang")[0].as_py(), table.column("slice")[0].as_py()
        sources = table.column("source").to_pylist()
        terms = _arrays(table.column("terms"), np.uint64)
        n, docs = _arrays(table.column("n"), np.uint32), _arrays(table.column("docs"), np.uint32)
        counted = [i for i, s in enumerate(sources) if s is not None]
        every = np.concatenate([terms[i] for i in counted]) if counted else np.empty(0, np.uint64)
        of = np.concatenate([docs[i] for i in counted]).astype(np.int64) if counted else np.empty(0, np.int64)
        _, found, in_docs = _merge(np.zeros(len(every), np.int8), every, of)
        kept = found[in_docs >= least_docs]

        spelled: dict[int, bytes] = {}
        for i, blob in enumerate(table.column("words").to_pylist()):
            if blob is not None:
                words = blob.split(b"\n")
                for j in np.flatnonzero(_within(terms[i], kept)).tolist():
                    spelled[int(terms[i][j])] = words[j]
        words = [spelled[t] for t in kept.tolist()]
        order = sorted(range(len(kept)), key=words.__getitem__)
        id_of = np.empty(len(kept), np.int64)
        id_of[order] = np.arange(len(kept))

        rows = []
        whole = np.zeros(len(kept), np.int64)
        by_source: dict[str, list[int]] = {}
        for i in counted:
            by_source.setdefault(sources[i], []).append(i)
        for source, places in by_source.items():
            mine = np.concatenate([terms[i] for i in places])
            count = np.concatenate([n[i] for i in places]).astype(np.int64)
            here = _within(mine, kept)
            ids = id_of[np.searchsorted(kept, mine[here])]
            _, ids, count = _merge(np.zeros(len(ids), np.int8), ids, count[here])
            whole[ids] += count
            rows.append((source, ids, count, None))
        rows.append((None, np.arange(len(kept)), whole, b"\n".join(words[i] for i in order)))
        return pa.table(
            {
                "lang": pa.array([lang] * len(rows), pa.string()),
                "slice": pa.array([slice_] * len(rows), pa.int64()),
                "source": pa.array([r[0] for r in rows], pa.string()),
                "ids": pa.array([r[1].astype(np.int32).tobytes() for r in rows], pa.binary()),
                "counts": pa.array([r[2].astype(np.int64).tobytes() for r in rows], pa.binary()),
                "words": pa.array([r[3] for r in rows], pa.binary()),
                "v": pa.array([len(kept)] * len(rows), pa.int64()),
                "total": pa.array([int(r[2].sum()) for r in rows], pa.int64()),
            }
        )

    return run


# --- prices ------------------------------------------------------------------------


def price(count: np.ndarray, n: int, v: int) -> np.ndarray:
    """``1 + floor(UNIT * (count + 2) / (n + 2 v))``, by long division in steps that stay
    inside 64 bits."""
    rest, quotient = count.astype(np.int64) + 2, 0
    for _ in range(UNIT_STEPS):
        digit, rest = np.divmod(rest * 1000, n + 2 * v)
        quotient = quotient * 1000 + digit
    return quotient + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def pair_value(
    a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: tuple[int, int], v: int, terms: int
) -> int:
    """What two sources' sorted (ids, counts) are apart over the ``terms`` terms of a slice;
    ``n`` are the sources' occurrences of all kept terms and ``v`` the number of those."""
    nothing = np.zeros(1, np.int64)
    p, q = price(a[1], n[0], v), price(b[1], n[1], v)
    p0, q0 = price(nothing, n[0], v), price(nothing, n[1], v)
    short, long = (a[0], b[0]) if len(a[0]) <= len(b[0]) else (b[0], a[0])
    # Keys in ascending order: the search goes on from the place of the one before.
    at = np.searchsorted(long, short)
    hit = np.zeros(len(short), bool)
    inside = at < len(long)
    hit[inside] = long[at[inside]] == short[inside]
    in_a, in_b = (np.flatnonzero(hit), at[hit]) if short is a[0] else (at[hit], np.flatnonzero(hit))
    both = apart(p[in_a], q[in_b]).sum()
    only_a = apart(p, q0).sum() - apart(p[in_a], q0).sum()
    only_b = apart(p0, q).sum() - apart(p0, q[in_b]).sum()
    neither = (terms - len(p) - len(q) + len(in_a)) * apart(p0, q0)[0]
    return int(both + only_a + only_b + neither)


def _side(batch: pa.RecordBatch, side: str) -> list[tuple[np.ndarray, np.ndarray]]:
    ids = _arrays(batch.column(f"ids{side}"), np.int32)
    return list(zip(ids, _arrays(batch.column(f"counts{side}"), np.int64), strict=True))


def _priced(pairs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            n = zip(batch.column("n").to_pylist(), batch.column("n_b").to_pylist(), strict=True)
            sizes = (batch.column("v").to_pylist(), batch.column("slice_v").to_pylist())
            values = [
                pair_value(a, b, *rest)
                for a, b, *rest in zip(_side(batch, ""), _side(batch, "_b"), n, *sizes, strict=True)
            ]
            columns = [batch.column(c) for c in ("lang", "source", "source_b")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.int64())], ["lang", "a", "b", "value"])

    return pairs.mapInArrow(run, "lang string, a string, b string, value long")


def _best_terms(rows: DataFrame, most: int) -> DataFrame:
    """The best ``most`` terms of every row, a source's slice with that of its language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, source, item, value = [], [], [], []
            facts = zip(*[batch.column(c).to_pylist() for c in ("lang", "source", "n", "v", "lang_n", "words")], strict=True)
            wholes = _arrays(batch.column("lang_counts"), np.int64)
            for (ids, counts), whole, (name, from_, n, v, lang_n, words) in zip(_side(batch, ""), wholes, facts, strict=True):
                p, q = price(counts, n, v), price(whole[ids], lang_n, v)
                above = np.flatnonzero(p > q)
                worth = apart(p[above], q[above])
                # Ids are in the order of the words, so equal values come in theirs.
                best = np.argsort(-worth, kind="stable")[:most]
                if len(best):
                    spelled = words.split(b"\n")
                    item += [spelled[i].decode("utf-8", "replace") for i in ids[above[best]].tolist()]
                    value += worth[best].tolist()
                    lang += [name] * len(best)
                    source += [from_] * len(best)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.string()) for x in (lang, source, item)] + [pa.array(value, pa.int64())],
                ["lang", "source", "item", "value"],
            )

    return rows.mapInArrow(run, "lang string, source string, item string, value long")


# --- the audit ---------------------------------------------------------------------


def _written(frame: DataFrame) -> DataFrame:
    path = new_folder(frame.sparkSession, "divergence")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def audit(
    docs: DataFrame, least_docs: int = LEAST_DOCS, most: int = 10, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """lang, source, part (``pair``: every other source of the language; ``term``: the
    ``most`` terms that the source has more of than its language), item, value and rank."""
    docs = docs.select(_text("lang"), _text("source"), _text("text"))
    groups = _written(docs.groupBy("lang", "source").agg(F.sum(F.octet_length("text")).alias("bytes")))
    size = groups.agg(F.sum("bytes")).first()[0] or 0
    bits = max(0, (int(size) // slice_bytes).bit_length())

    counted = _counted(docs, bits)
    kept = _written(counted.groupBy("lang", "slice").applyInArrow(_merged(least_docs), _MERGED))
    whole = kept.where("source is null").select(
        "lang", "slice", F.col("v").alias("slice_v"), F.col("counts").alias("lang_counts"), "words", "total"
    )
    own = kept.where("source is not null").select("lang", "slice", "source", "ids", "counts", "total")

    langs = whole.groupBy("lang").agg(F.sum("slice_v").alias("v"), F.sum("total").alias("lang_n"))
    sums = own.groupBy("lang", "source").agg(F.sum("total").alias("n"))
    sized = _written(
        groups.select("lang", "source").join(langs, "lang", "left").join(sums, ["lang", "source"], "left")
        .na.fill(0, ["v", "lang_n", "n"])
    )

    # Every source has a row in every slice of its language, also without terms there.
    slices = whole.where("slice_v > 0").select("lang", "slice", "slice_v")
    laid = slices.join(sized, "lang").join(own.drop("total"), ["lang", "slice", "source"], "left")
    laid = _written(laid)
    other = laid.select(
        "lang", "slice", *[F.col(c).alias(f"{c}_b") for c in ("source", "n", "ids", "counts")]
    )
    met = laid.join(other, ["lang", "slice"]).where(F.col("source") < F.col("source_b"))
    priced = _written(_priced(met).groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))

    names = sized.select("lang", "source")
    pairs = names.join(names.select("lang", F.col("source").alias("item")), "lang").where("source != item")
    pairs = (
        pairs.withColumns({"a": F.least("source", "item"), "b": F.greatest("source", "item")})
        .join(priced, ["lang", "a", "b"], "left")
        .select("lang", "source", "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).cast("int").alias("rank")

    rows = own.drop("total").join(sized, ["lang", "source"]).join(whole.drop("total"), ["lang", "slice"])
    best = _written(_best_terms(rows, most))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    by_pair = pairs.select("*", rank, F.lit("pair").alias("part")).select(columns)
    by_term = best.select("*", rank, F.lit("term").alias("part")).where(F.col("rank") <= most).select(columns)
    return by_pair.unionByName(by_term)
