"""Quality rules whose limits follow the data: quantile sketches per language and source.

Every text gets a few counts. Some rules are fixed (``base_failed``: fewer than
``MIN_WORDS`` words, or more than ``MAX_REPEAT`` percent of the words in repeated
windows). The other limits are learned from the texts that pass those:

- the ratios of ``RULES`` are summarised in one KLL sketch per (lang, source);
- sketches merge, so those of a language, and of everything, come from the small ones
  without another look at the texts. A group with fewer than ``min_group`` texts uses its
  language's sketch, a language with fewer the one of everything;
- a limit lies ``width`` spreads from the median, the spread being the distance from the
  median to the tenth percentile (which the junk above the median does not move), and at
  least the rule's ``least``. Chance moves the ratio of a short text further, so a rule
  may add ``noise / sqrt(words)``;
- the limits are joined to the counts, and a text outside of any is not kept.

Counts and limits are written to the shared folder once: the texts are read once, and a
lost executor cannot change a limit, although large sketches draw random numbers. All of
it is DataFrame code; a group reaches a task as sketches only, one per task before it.

Null and empty texts have no words, fail the base rules and enter no sketch. A null
language or source is a group like any other. Repeated rows count each; an empty table
gives an empty result. Only doc_id, text, lang and source are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tickflow.llm.text import TRIM, words
from tickflow.scratch import new_folder

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT = 20


@dataclass(frozen=True)
class Rule:
    """Limits of one ratio, in spreads from the median of its group."""

    name: str
    ratio: str
    least: float
    width: float = 7.0
    noise: float = 0.0
    both: bool = False


RULES = (
    Rule("symbols", "n_symbols / nullif(word_chars, 0)", least=0.004),
    Rule("dup_lines", "n_dup_lines / nullif(n_lines, 0)", least=0.05),
    Rule("word_length", "word_chars / nullif(n_words, 0)", least=0.2, noise=11.0, both=True),
)


def _covered(windows: str) -> Column:
    """Words in windows that occur twice or more, from the hashes of all windows.

    Hashes are sorted with their positions, equal neighbours are repeated, and their
    positions in order tell how far each window reaches before the next begins."""
    size = F.size("_sorted")
    at = lambda j: F.get("_sorted", j)
    repeated = F.filter(
        F.transform(
            F.sequence(F.lit(0), size - 1),
            lambda j: F.when(
                ((j > 0) & (F.get("_sorted", j - 1).h == at(j).h))
                | ((j < size - 1) & (F.get("_sorted", j + 1).h == at(j).h)),
                at(j).i,
            ),
        ),
        lambda i: i.isNotNull(),
    )
    return F.when(F.col("_sorted").isNotNull(), F.sort_array(repeated))


def counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every text."""
    word_hash = lambda i, j: F.get("_hashes", i + j)
    # Each step is used several times by the next, so none is computed twice.
    steps = (
        docs.select("doc_id", "lang", "source", "text", words(F.col("text")).alias("_words"))
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.char_length(F.array_join("_words", "")).cast("long"))
        .withColumn("n_symbols", F.coalesce(F.regexp_count("text", F.lit(SYMBOLS)), F.lit(0)).cast("long"))
        .withColumn(
            "_lines",
            F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(TRIM)) != ""),
        )
        .withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .drop("text", "_words", "_lines")
        .withColumn(
            "_windows",
            F.when(
                F.size("_hashes") >= WINDOW,
                F.transform(
                    F.sequence(F.lit(0), F.size("_hashes") - WINDOW),
                    lambda i: F.xxhash64(*[word_hash(i, j) for j in range(WINDOW)]),
                ),
            ),
        )
        .withColumn(
            "_sorted",
            F.when(
                F.size(F.array_distinct("_windows")) < F.size("_windows"),
                F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            ),
        )
        .drop("_hashes", "_windows")
        .withColumn("_starts", _covered("_sorted"))
    )
    steps_between = F.zip_with(
        F.slice("_starts", 2, F.size("_starts") - 1),
        F.slice("_starts", 1, F.size("_starts") - 1),
        lambda later, earlier: F.least(later - earlier, F.lit(WINDOW)),
    )
    covered = F.aggregate(steps_between, F.lit(WINDOW), lambda total, x: total + x)
    return steps.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.when(F.col("_starts").isNull(), 0).otherwise(covered).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")
    )


def _quantile(sketch: str, rank: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(rank))


def limits(counted: DataFrame, k: int, min_group: int) -> DataFrame:
    """Per (lang, source): the median and the spread of every rule's ratio."""
    names = [r.name for r in RULES]
    groups = (
        counted.where(~base_failed())
        .select("lang", "source", *[F.expr(r.ratio).alias(r.name) for r in RULES])
        .groupBy("lang", "source")
        .agg(F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(n, F.lit(k)).alias(n) for n in names])
    )
    merged = [F.sum("n").alias("n"), *[F.kll_merge_agg_double(n, F.lit(k)).alias(n) for n in names]]
    renamed = lambda frame, p: frame.select(
        *[F.col(c).alias(c if c in ("lang", "source") else f"{p}_{c}") for c in frame.columns]
    )
    # Three levels of sketches; the coarser ones are a few rows.
    by_lang = renamed(groups.groupBy("lang").agg(*merged), "lang").withColumnRenamed("lang", "_lang")
    total = renamed(groups.agg(*merged), "all").withColumn("_one", F.lit(1))
    levels = groups.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")))
    levels = levels.withColumn("_one", F.lit(1)).join(total, "_one")
    chosen = lambda name: (
        F.when(F.col("n") >= min_group, F.col(name))
        .when(F.col("lang_n") >= min_group, F.col(f"lang_{name}"))
        .otherwise(F.col(f"all_{name}"))
    )
    picked = levels.select("lang", "source", *[chosen(n).alias(n) for n in names])
    return picked.select(
        "lang", "source",
        *[_quantile(n, 0.5).alias(f"{n}_median") for n in names],
        *[(_quantile(n, 0.5) - _quantile(n, 0.1)).alias(f"{n}_spread") for n in names],
    )


def passes(rule: Rule) -> Column:
    allowed = (
        rule.width * F.greatest(F.col(f"{rule.name}_spread"), F.lit(rule.least))
        + F.lit(rule.noise) / F.sqrt(F.nullif("n_words", F.lit(0)))
    )
    off = F.expr(rule.ratio) - F.col(f"{rule.name}_median")
    return (F.abs(off) if rule.both else off) <= allowed


def judge(docs: DataFrame, k: int = 4096, min_group: int = 100) -> DataFrame:
    """The counts of every row, ``base_failed``, and ``kept``. ``k`` is the size of a
    sketch: groups of up to that many texts are summarised without loss."""
    spark = docs.sparkSession
    path = new_folder(spark, "quality-counts")
    counts(docs).write.parquet(path)
    counted = spark.read.parquet(path)
    path = new_folder(spark, "quality-limits")
    limits(counted, k, min_group).write.parquet(path)
    learned = spark.read.parquet(path).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    fits = F.lit(True)
    for rule in RULES:
        fits &= passes(rule)
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    return counted.join(learned, same, "left").select(
        *counted.columns,
        base_failed().alias("base_failed"),
        (~base_failed() & F.coalesce(fits, F.lit(False))).alias("kept"),
    )
