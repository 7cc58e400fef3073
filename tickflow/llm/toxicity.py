"""Toxicity by class-conditional Kneser-Ney models of words.

Toxic words come inflected, each form rarely, so words back off to their stems: the first
``STEM`` code points, A-Z as a-z. Two models, of toxic and of ordinary labelled texts, give
a word its discounted share of the class's words. What the discount frees goes to its
stem's probability, shared alike by the stem's words; that is the stem's discounted share,
and what this frees goes to the same backoff for both classes: the Kneser-Ney continuation
share, the number of different words over all labelled texts that continue the stem. A word
whose stem is rare in both classes then says next to nothing; one that a single class uses
often says much. Words are counted per task and class before the shuffle, and all counts
cover all labelled texts to learn from.

A text's figures are length-normalised differences of its two log-likelihoods (toxic less
ordinary): over the whole text, and over its likeliest tenth, fiftieth and single word, as
texts may be toxic in a few places only; of ``n`` words a share ``s`` is the ``max(1, s n)``
words, rounded up, of the largest log-likelihood ratios, and the figure their mean. A
logistic curve over the figures makes a probability; it is fitted on about ``sample_rows``
labelled texts, chosen by a hash of their ids. Words have no history: an expression made of
ordinary words is not seen.

Words of more than ``DISCOUNT`` uses in a class and all stems keep their ratios; other words
have just what their stem says, and only words of stems never seen count as equally likely.
Up to ``BROADCAST_ROWS`` ratios (16 bytes each) are handed to the workers, and scoring is
one pass over the documents, without a shuffle. More stay a table, which is joined with the
words of every different text, counted per text.

Null and empty texts have no words: their figures are 0. If one class has no labelled text,
scores are constant: 1 or 0 for the class there is, and 0.5 without labels. Repeated rows
are scored alike; an empty table gives no rows. All columns pass through, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickflow.llm import logistic
from tickflow.llm.labels import labelled, sample
from tickflow.llm.words import LETTERS, Tokens, mix, over_batches, packed, token_chunks
from tickflow.scratch import new_folder

STEM = 5
DISCOUNT = 2.0
# Shares of a text's words, those of the largest ratios, whose mean ratios are its figures.
SHARES = (1.0, 0.1, 0.02, 0.0)
FIGURES = [f"figure{i}" for i in range(len(SHARES))]
BROADCAST_ROWS = 1_000_000

_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_STEP = np.uint64(0x9FB21C651E98DF25)


def stems(found: Tokens) -> np.ndarray:
    """Hashes of the first code points of every word."""
    begins = (found.data & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(begins)])
    place = np.concatenate([np.flatnonzero(begins), [len(found.data)]])
    upto = place[np.minimum(before[found.start] + STEM, len(place) - 1)]
    length = np.minimum(upto, found.end) - found.start
    key = np.zeros(len(length), np.uint64)
    left, j = np.arange(len(length)), 0
    while len(left := left[length[left] > j]):
        key[left] = key[left] * _STEP + (_LOWER[found.data[found.start[left] + j]] + np.uint64(1))
        j += 1
    return mix(key).view(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words by hash with their stems and counts per class, summed over 2 million words."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def summed() -> pa.RecordBatch:
        word, stem, toxic = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(word)
        word, stem, toxic = word[order], stem[order], toxic[order]
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        total = np.diff(np.concatenate([first, [len(word)]]))
        tox = np.add.reduceat(toxic.astype(np.int64), first)
        columns = [word[first].view(np.int64), stem[first], tox, total - tox]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], ["word", "stem", "toxic", "ordinary"]
        )

    for batch in batches:
        label = batch.column("label").to_numpy() > 0
        for row, found in token_chunks(batch.column("text"), LETTERS):
            held.append((found.hash, stems(found), label[row + found.rows()]))
            size += len(found.hash)
            if size >= 1 << 21:
                yield summed()
                held, size = [], 0
    if size:
        yield summed()


def ratios(words: DataFrame) -> DataFrame:
    """key and ``ratio``, the log of toxic over ordinary probability, from words with their
    stems and counts. Keys are stems, for words without a row of their own, and words."""
    spark, both = words.sparkSession, ("toxic", "ordinary")
    path = new_folder(spark, "toxicity-stems")
    words.groupBy("stem").agg(
        *[F.sum(c).alias(c) for c in both], F.count(F.lit(1)).alias("kinds")
    ).write.parquet(path)
    stemmed = spark.read.parquet(path)
    freed = [F.sum(F.least(F.col(c), F.lit(DISCOUNT))) for c in both]
    every = dict(zip(both, words.agg(*[F.sum(c) for c in both]).first(), strict=True))
    word_free = dict(zip(both, words.agg(*freed).first(), strict=True))
    *stem_free, kinds = stemmed.agg(*freed, F.sum("kinds")).first()
    stem_free = dict(zip(both, stem_free, strict=True))

    def share(c: str, free: dict, backoff: Column) -> Column:
        return (F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) + F.lit(free[c]) * backoff) / F.lit(every[c])

    known = stemmed.select(
        "stem", "kinds", *[share(c, stem_free, F.col("kinds") / F.lit(kinds)).alias(f"{c}_stem") for c in both]
    )
    # What all words without a row of their own have besides their stem's ratio.
    rest = np.log(word_free["toxic"] / every["toxic"]) - np.log(word_free["ordinary"] / every["ordinary"])
    own = words.where(F.greatest(*both) > DISCOUNT).join(known, "stem")
    word = {c: share(c, word_free, F.col(f"{c}_stem") / F.col("kinds")) for c in both}
    return known.select(
        F.col("stem").alias("key"), (F.log(F.col("toxic_stem") / F.col("ordinary_stem")) + F.lit(float(rest))).alias("ratio")
    ).union(own.select(F.col("word").alias("key"), F.log(word["toxic"] / word["ordinary"]).alias("ratio")))


@dataclass
class Model:
    """Ratios by key, in the keys' order, or the ``path`` of their table, and the logistic
    curve over a text's figures."""

    key: np.ndarray
    ratio: np.ndarray
    path: str | None
    curve: np.ndarray

    def known(self, found: Tokens) -> np.ndarray:
        """The words' ratios: their own, else their stem's, else 0."""
        out = np.zeros(len(found.hash))
        if not len(self.key):
            return out
        for keys in (stems(found), found.hash.view(np.int64)):
            at = np.minimum(np.searchsorted(self.key, keys), len(self.key) - 1)
            out = np.where(self.key[at] == keys, self.ratio[at], out)
        return out

    def figures(self, texts: pa.Array) -> list[pa.Array]:
        """The mean ratio of each share of the words."""
        out = np.zeros((len(SHARES), len(texts)))
        for row, found in token_chunks(texts, LETTERS):
            n, ratio = found.counts, self.known(found)
            ratio = ratio[np.lexsort((-ratio, found.rows()))]
            total = np.concatenate([[0.0], np.cumsum(ratio)])
            for i, share in enumerate(SHARES):
                words = np.minimum(_words_of(share, n), n)
                sums = total[found.bounds[:-1] + words] - total[found.bounds[:-1]]
                out[i, row : row + len(n)] = sums / np.maximum(words, 1)
        return [pa.array(x) for x in out]


def _words_of(share: float, n: np.ndarray) -> np.ndarray:
    return np.maximum(1, np.ceil(n * share)).astype(np.int64)


def _model(learned: DataFrame) -> Model:
    path = new_folder(learned.sparkSession, "toxicity-ratios")
    learned.write.parquet(path)
    table = learned.sparkSession.read.parquet(path)
    if table.count() > BROADCAST_ROWS:
        return Model(np.empty(0, np.int64), np.empty(0), path, np.zeros(len(SHARES) + 1))
    rows = table.toArrow().sort_by("key")
    return Model(rows.column("key").to_numpy(), rows.column("ratio").to_numpy(), None, np.zeros(len(SHARES) + 1))


def _text_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts by hash with their number of words, and their words with stems and counts."""
    for batch in batches:
        prints = batch.column("print").to_numpy()
        for row, found in token_chunks(batch.column("text"), LETTERS):
            word, stem, of = found.hash.view(np.int64), stems(found), found.rows()
            order = np.lexsort((word, of))
            word, stem, of = word[order], stem[order], of[order]
            new = np.concatenate([[True], (word[1:] != word[:-1]) | (of[1:] != of[:-1])])
            first = np.flatnonzero(new[: len(word)])
            n = np.diff(np.concatenate([first, [len(word)]]))
            columns = [prints[row + of[first]], found.counts[of[first]], word[first], stem[first], n]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["print", "words", "word", "stem", "n"]
            )


def _figured(frame: DataFrame, carry: list[str], model: Model) -> DataFrame:
    """The columns ``carry`` of ``frame``, which has a text, and the text's figures."""
    spark = frame.sparkSession
    if model.path is None:
        shared = spark.sparkContext.broadcast(model)
        return over_batches(
            frame,
            lambda: lambda batch: shared.value.figures(batch.column("text")),
            carry, ", ".join(f"{f} double" for f in FIGURES),
        )
    text = frame.select(F.xxhash64("text").alias("print"), "text")
    counted = text.mapInArrow(_text_words, "print long, words long, word long, stem long, n long")
    learned = spark.read.parquet(model.path)
    own = learned.select(F.col("key").alias("word"), F.col("ratio").alias("own"))
    ratio = F.coalesce("own", "ratio", F.lit(0.0)).alias("ratio")
    # A text's words by their ratios, with the number of words before each.
    order = Window.partitionBy("print").orderBy(F.desc("ratio"), "word")
    before = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    ranked = (
        counted.groupBy("print", "words", "word", "stem").agg(F.max("n").alias("n"))
        .join(own, "word", "left")
        .join(learned.withColumnRenamed("key", "stem"), "stem", "left")
        .select("print", "words", "word", "n", ratio)
        .withColumn("before", F.coalesce(before, F.lit(0)))
    )
    means = []
    for share, name in zip(SHARES, FIGURES, strict=True):
        words = F.greatest(F.lit(1), F.ceil(F.col("words") * F.lit(share)))
        inside = F.greatest(F.least(F.col("n"), words - F.col("before")), F.lit(0))
        means.append((F.sum(inside * F.col("ratio")) / F.first(words)).alias(name))
    # Written plainly: a join of two shuffled sides can split a text of many copies.
    path = new_folder(spark, "toxicity-figures")
    ranked.groupBy("print").agg(*means).write.parquet(path)
    rows = frame.select(*carry, F.xxhash64("text").alias("print"))
    return rows.join(spark.read.parquet(path), "print", "left").select(
        *carry, *[F.coalesce(c, F.lit(0.0)).alias(c) for c in FIGURES]
    )


def train(
    docs: DataFrame, labels: DataFrame, held_out: Column, column: str = "toxic", sample_rows: int = 20_000
) -> Model:
    """Learn from the documents whose labels are not ``held_out`` (a condition on doc_id)."""
    spark = docs.sparkSession
    rows, n = labelled(docs, labels, column, held_out)
    path = new_folder(spark, "toxicity-words")
    (
        rows.select("text", "label")
        .mapInArrow(_count, "word long, stem long, toxic long, ordinary long")
        .groupBy("word", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
        .write.parquet(path)
    )
    counted = spark.read.parquet(path)
    both = counted.agg(F.sum("toxic"), F.sum("ordinary")).first()
    if not (both[0] and both[1]):
        prior = 30.0 if both[0] else -30.0 if both[1] else 0.0
        curve = np.append(np.zeros(len(SHARES)), prior)
        return Model(np.empty(0, np.int64), np.empty(0), None, curve)
    model = _model(ratios(counted))

    held = _figured(sample(rows, n, sample_rows), ["doc_id", "label"], model).toArrow()
    held = held.sort_by([(c, "ascending") for c in ("doc_id", *FIGURES)])
    x = np.column_stack([held.column(c).to_numpy() for c in FIGURES])
    spread = np.maximum(x.std(axis=0), 1e-9)
    w = logistic.fit(x / spread, (held.column("label").to_numpy() > 0).astype(float), ridge=3e-3)
    model.curve = np.append(w[:-1] / spread, w[-1])
    return model


def score(docs: DataFrame, model: Model, columns: tuple[str, ...] = ()) -> DataFrame:
    """``doc`` (the row's ``columns``, all by default) and ``score``, the probability that
    the text is toxic."""
    *weights, margin = [F.lit(w) for w in model.curve.tolist()]
    for name, weight in zip(FIGURES, weights, strict=True):
        margin = margin + F.col(name) * weight
    margin = F.greatest(F.least(margin, F.lit(30.0)), F.lit(-30.0))
    found = _figured(packed(docs, *columns), ["doc"], model)
    return found.select("doc", (1 / (1 + F.exp(-margin))).alias("score"))
