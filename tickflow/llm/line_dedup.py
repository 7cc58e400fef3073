"""Line dedup against levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at both ends, A-Z in lower case. The
index (``LineRuns``) holds a row per key: in how many documents it was met, and its
holder, the one document that may keep it. Batches come in descending order of doc_id,
so the first document to show a key is its holder:

- a batch is aggregated to its distinct keys, in one shuffle;
- it is merge-joined with every run: keys that no run has are fresh and bring their
  holder, the others only add to the count;
- that is written as the batch's own run. ``fanout`` runs of a level are merged into one
  run of the next, so a batch meets few runs however many came before.

Runs are bucketed and sorted by key in the shared folder, so reading, joining and merging
them needs no shuffle. A key that a third of all documents share is one row per task
before the batch's shuffle, and one row in a run.

In the end the lines are joined with the keys to drop. Their positions go to the
documents, which are shuffled once, and the texts are put together from the positions
that are left. Everything is DataFrame code.

Null and empty texts are one empty line. Documents are told apart by doc_id; a null
doc_id is one document and comes before all others. Repeated rows are cleaned alike. An
empty table gives an empty result. Only doc_id and text are read; all other columns of
``clean`` pass through whatever their names.
"""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickflow.llm.text import TRIM, lower_ascii
from tickflow.scratch import new_folder, note_table

NO_ID = -(2**63)


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def doc_key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(NO_ID))


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """A row per line with a key of at least ``min_chars`` code points: doc, fingerprint
    of the text, position in it, hash of the key."""
    return (
        docs.select(
            doc_key(F.col("doc_id")).alias("doc"), F.xxhash64("text").alias("print"),
            F.posexplode(lines(F.col("text"))).alias("pos", "line"),
        )
        .withColumn("line", lower_ascii(F.btrim("line", F.lit(TRIM))))
        .where(F.char_length("line") >= min_chars)
        .select("doc", "print", "pos", F.xxhash64("line").alias("key"))
    )


class LineRuns:
    """The index: runs of (key, n_docs, holder) by level, newest last."""

    def __init__(self, spark: SparkSession, fanout: int = 2, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = new_folder(spark, "line-runs")
        self.levels: list[list[str]] = [[]]

    def _write(self, run: DataFrame) -> str:
        name = note_table(f"line_run_{uuid4().hex}")
        (
            run.repartition(self.buckets, "key")
            .write.bucketBy(self.buckets, "key").sortBy("key")
            .format("parquet").option("path", f"{self.folder}/{name}").saveAsTable(name)
        )
        return name

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _merged(self, names: list[str]) -> DataFrame:
        """Runs merged pairwise; every key has one holder, the first it got."""

        def two(left: DataFrame, right: DataFrame) -> DataFrame:
            right = right.select("key", F.col("n_docs").alias("_n"), F.col("holder").alias("_h"))
            count = F.coalesce("n_docs", F.lit(0)) + F.coalesce("_n", F.lit(0))
            return left.hint("merge").join(right, "key", "full").select(
                "key", count.alias("n_docs"), F.coalesce("holder", "_h").alias("holder")
            )

        return reduce(two, [self.spark.table(n) for n in names])

    def add(self, batch: DataFrame) -> DataFrame:
        """Take in a batch of (key, doc), whose documents all have smaller ids than those
        before. Returns its own run; its fresh keys are those with a holder."""
        found = batch.groupBy("key").agg(
            F.count_distinct("doc").alias("n_docs"), F.max("doc").alias("holder")
        )
        known = F.lit(False)
        for i, name in enumerate(self.runs()):
            mark = self.spark.table(name).select("key", F.lit(True).alias(f"_{i}"))
            found = found.join(mark.hint("merge"), "key", "left")
            known |= F.col(f"_{i}").isNotNull()
        run = self._write(found.select("key", "n_docs", F.when(~known, F.col("holder")).alias("holder")))
        self.levels[0].append(run)
        self._compact()
        return self.spark.table(run)

    def _compact(self) -> None:
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged = self._write(self._merged(self.levels[level]))
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(merged)
            self.levels[level] = []
            level += 1

    def totals(self) -> DataFrame:
        """One row per key over all runs."""
        return self._merged([name for level in reversed(self.levels) for name in level])


def clean(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4, fanout: int = 2
) -> DataFrame:
    """All rows of ``docs`` as ``doc`` (a struct of their columns), with ``n_lines``,
    ``n_dropped`` and ``kept``: the text without the lines that at least ``min_docs``
    documents have, except in the one with the largest doc_id."""
    spark = docs.sparkSession
    # Between quantiles of the ids, the largest first. Only comparisons: no document is
    # between two batches or beyond the last.
    shares = [i / batches for i in range(1, batches)]
    bounds = docs.agg(F.percentile_approx(doc_key(F.col("doc_id")), shares)).first()[0] if shares else []
    batch = sum((F.when(F.col("doc") < b, 1).otherwise(0) for b in bounds or []), F.lit(0))
    path = new_folder(spark, "line-keys")
    line_keys(docs, min_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    keys = spark.read.schema("doc long, print long, pos int, key long, batch int").parquet(path)

    runs = LineRuns(spark, fanout)
    for number in range(batches):
        runs.add(keys.where(F.col("batch") == number).select("key", "doc"))
    # Written plainly: a join of two shuffled sides can split a key of many lines.
    path = new_folder(spark, "line-repeated")
    runs.totals().where(F.col("n_docs") >= min_docs).select("key", "holder").write.parquet(path)
    dropped = (
        keys.join(spark.read.parquet(path), "key")
        .where("doc != holder")
        .groupBy(F.col("doc").alias("_doc"), F.col("print").alias("_print"))
        .agg(F.collect_set("pos").alias("_dropped"))
    )
    rows = docs.select(F.struct("*").alias("doc")).select(
        "doc", doc_key(F.col("doc.doc_id")).alias("_key"), F.xxhash64("doc.text").alias("_fp")
    )
    text = F.coalesce("doc.text", F.lit(""))
    split = rows.join(
        dropped, (F.col("_key") == F.col("_doc")) & (F.col("_fp") == F.col("_print")), "left"
    ).withColumn("_lines", lines(F.col("doc.text")))
    n_lines = F.size("_lines")
    left = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col("_dropped"))
    kept = F.array_join(F.transform(left, lambda i: F.get("_lines", i)), "\n")
    return split.select(
        "doc",
        n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("_dropped").isNull(), text).otherwise(kept).alias("kept"),
    )
