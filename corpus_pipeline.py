"""A corpus pipeline: documents in, training mix out.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but
the last return the columns of ``documents``; the last returns them too, a row per copy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickflow.llm import near_dups, quality_classifier
from tickflow.llm.decontaminate import decontaminate
from tickflow.llm.line_dedup import clean
from tickflow.llm.mixing import materialise, mix
from tickflow.llm.text import TRIM, table
from tickflow.scratch import new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier finds more likely bad than good. It learns
    from the labels of the documents that are here."""
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"), F.lit(False))
    return quality_classifier.score(docs, model).where("score >= 0.5").select("doc.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that at least three documents have, but for the one that keeps them.
    A document that has lost all its text goes; others stay as they are."""
    cleaned = clean(docs)
    touched = F.col("n_dropped") > 0
    left = ~touched | (F.btrim("kept", F.lit(TRIM)) != "")
    new = {"text": F.col("kept"), "n_chars": F.char_length("kept")}
    return cleaned.where(left).select(
        *[
            F.when(touched, new[c].cast(docs.schema[c].dataType)).otherwise(F.col(f"doc.{c}")).alias(c)
            if c in new else F.col(f"doc.{c}").alias(c)
            for c in docs.columns
        ]
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group that shares four fifths of its five-word shingles."""
    return near_dups.drop_copies(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages of benchmark items, and without documents that are mostly those."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources to their target weights: whole copies and cut texts."""
    return materialise(docs, mix(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("mixing", mixing),
]

# A trained classifier and signatures of hashed words decide, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
