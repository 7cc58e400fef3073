"""Mix sources to target weights by apportionment of equal blocks of words.

1. Targets: every source gets its share of all words by weight, at most ``max_repeat``
   times what it has; what is cut off goes to the others by weight until none is above.
2. Quotas: all words make so many blocks of ``block`` words. Blocks go to the sources by
   the highest quotients ``target / (2k + 1)`` (Sainte-Lague), and each source's blocks
   go to its shards in the same way, so every shard has a whole number of blocks.
3. Selection: a shard lays its documents end to end in a seeded order and cuts them into
   blocks. It takes whole passes while its quota allows, then the blocks with the
   smallest seeded hashes.

A source is split into shards by a hash of its documents, ``shard_rows`` documents each
on average, so that a source with a third of all rows is many small groups. Everything is
DataFrame code; no task sees more than a shard, or one row per source.

Null texts have no words and are never taken; a null source is a source of its own and
comes last; an empty table gives an empty result. Rows that are equal in every column are
separate rows. Only the named columns are read, so further columns do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickflow.llm.text import word_count, words
from tickflow.scratch import new_folder

CYCLE = (1, 2, 3)


def _hash(*parts: Column | str) -> Column:
    """60 bits of a hash that any engine can compute."""
    text = F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, cycle: tuple[int, ...] = CYCLE, max_repeat: int = 3) -> DataFrame:
    """One row per source of ``sizes`` (source, size): ``source_no``, ``source_size``,
    ``n_docs`` and ``target``. Weights repeat over the sources in code point order."""
    sources = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(
        F.array(*[F.lit(w) for w in cycle]), ((F.col("source_no") - 1) % len(cycle) + 1)
    )
    everything = Window.partitionBy()
    # Sources reach their ceiling in the order of ceiling / weight.
    before = Window.orderBy(F.col("ceiling") / F.col("weight"), "source_no").rowsBetween(
        Window.unboundedPreceding, -1
    )
    wide = lambda c: c.cast("decimal(38,0)")  # noqa: E731  products of two counts
    ranked = (
        sources.withColumn("source_no", number)
        .withColumn("weight", weight.cast("long"))
        .withColumn("ceiling", F.col("source_size") * max_repeat)
        .withColumn("words", F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("left", F.col("words") - F.coalesce(F.sum("ceiling").over(before), F.lit(0)))
        .withColumn("rest", F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn(
            "full",
            wide(F.col("ceiling")) * F.col("rest") <= wide(F.col("left")) * F.col("weight"),
        )
    )
    some = lambda c, otherwise: F.when(F.col("full"), F.col(c)).otherwise(otherwise)
    shared = (
        (F.col("words") - F.sum(some("ceiling", 0)).over(everything)) * F.col("weight")
    ).cast("double") / (F.col("weights") - F.sum(some("weight", 0)).over(everything))
    return ranked.withColumn(
        "target", some("ceiling", shared).cast("double")
    ).select("source", "source_no", "source_size", "n_docs", "words", "target")


def apportion(parties: DataFrame, group: list[str], party: str, votes: str, seats: str) -> DataFrame:
    """Add ``quota``: the ``seats`` of each group, dealt out by the highest quotients
    votes / (2k + 1), ties to the smaller ``party``.

    Quotas lie within ``votes * (seats +- parties / 2) / all votes``, so only the few
    quotients between those bounds are ranked: at most five per party."""
    whole = Window.partitionBy(*group)
    share = F.col(votes).cast("double") / F.col("_all")
    half = F.col("_parties") / 2.0
    bounded = (
        parties.where(F.col(votes) > 0)
        .withColumn("_all", F.sum(F.col(votes).cast("double")).over(whole))
        .withColumn("_parties", F.count(F.lit(1)).over(whole))
        .withColumn(
            "_low",
            F.greatest(F.lit(0), F.floor(share * (F.col(seats) - half) + 0.5) - 1).cast("long"),
        )
        .withColumn("_high", F.floor(share * (F.col(seats) + half) + 0.5).cast("long") + 1)
        .withColumn("_left", F.col(seats) - F.sum("_low").over(whole))
    )
    best = Window.partitionBy(*group).orderBy(F.desc("_quotient"), party)
    extra = (
        bounded.select(*group, party, votes, "_left", F.explode(F.sequence("_low", "_high")).alias("_k"))
        .withColumn("_quotient", F.col(votes).cast("double") / (2 * F.col("_k") + 1))
        .withColumn("_rank", F.row_number().over(best))
        .where("_rank <= _left")
        .groupBy(*group, party)
        .agg(F.count(F.lit(1)).alias("_extra"))
    )
    low = bounded.select(*group, party, "_low")
    return (
        parties.join(low, [*group, party], "left")
        .join(extra, [*group, party], "left")
        .withColumn("quota", F.coalesce("_low", F.lit(0)) + F.coalesce("_extra", F.lit(0)))
        .drop("_low", "_extra")
    )


def _stored(frame: DataFrame) -> DataFrame:
    """A table of sources or shards, written out once: several steps use it."""
    path = new_folder(frame.sparkSession, "mix")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def mix(
    docs: DataFrame,
    cycle: tuple[int, ...] = CYCLE,
    max_repeat: int = 3,
    block: int = 100,
    shard_rows: int = 4000,
    seed: str = "mix",
) -> DataFrame:
    """What the mix takes of every row of ``docs`` (doc_id, source, text).

    Columns: doc_id, source, size, source_size, target, ``passes`` (whole texts taken),
    ``spans`` (further word ranges [first, last), in order) and ``taken`` (words, repeats
    counted, at most ``max_repeat`` times the size). The word counts are written to the
    shared folder once, so the texts are read once.
    """
    sizes = _stored(
        docs.select(
            "doc_id", F.col("source").cast("string").alias("source"),
            word_count(F.col("text")).alias("size"),
        )
    )

    sources = _stored(targets(sizes, cycle, max_repeat))
    blocks = F.ceil(F.col("words") / F.lit(float(block))).cast("long")
    sources = _stored(
        apportion(
            sources.withColumn("seats", blocks).withColumn("all", F.lit(0)),
            ["all"], "source_no", "target", "seats",
        ).withColumn("shards", F.ceil(F.col("n_docs") / F.lit(float(shard_rows))).cast("long"))
    )

    order = _hash(seed, F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size"))
    rows = sizes.join(
        sources.select(
            F.col("source").alias("_source"), "source_no", "source_size", "target", "shards",
            F.col("quota").alias("source_quota"),
        ),
        F.col("source").eqNullSafe(F.col("_source")),
    ).drop("_source").withColumn("order", order)
    rows = rows.withColumn("shard", F.pmod(F.col("order"), F.col("shards")))

    # The shards' quotas.
    shards = _stored(
        rows.groupBy("source_no", "shard").agg(
            F.sum("size").alias("shard_size"), F.max("source_quota").alias("source_quota")
        )
    )
    shards = _stored(
        apportion(shards, ["source_no"], "shard", "shard_size", "source_quota")
        .withColumn("n_blocks", F.ceil(F.col("shard_size") / F.lit(float(block))).cast("long"))
        .withColumn("quota", F.least("quota", F.col("n_blocks") * max_repeat))
        .where("n_blocks > 0")
        .withColumn("passes", F.expr("quota div n_blocks"))
        .withColumn("rest", F.expr("quota % n_blocks"))
    )

    # Whole passes, then the blocks with the smallest hashes.
    laid = Window.partitionBy("source_no", "shard").orderBy("order", "doc_id", "size")
    placed = (
        rows.withColumn("end", F.sum("size").over(laid.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("start", F.col("end") - F.col("size"))
        .join(shards.select("source_no", "shard", "passes"), ["source_no", "shard"], "left")
    )
    drawn = Window.partitionBy("source_no", "shard").orderBy("_draw", "block")
    chosen = (
        shards.where("rest > 0")
        .select("source_no", "shard", "rest", F.explode(F.expr("sequence(0L, n_blocks - 1)")).alias("block"))
        .withColumn("_draw", _hash(seed, F.col("source_no"), F.col("shard"), F.col("block")))
        .withColumn("_rank", F.row_number().over(drawn))
        .where("_rank <= rest")
        .select("source_no", "shard", "block")
    )
    pieces = (
        placed.where("size > 0")
        .select(
            "source_no", "shard", "start", "end",
            F.explode(F.expr(f"sequence(start div {block}, (end - 1) div {block})")).alias("block"),
        )
        # Spark takes the chosen blocks for as small as their shards; they are not.
        .join(chosen.hint("merge"), ["source_no", "shard", "block"])
        .select(
            "source_no", "shard", "start",
            (F.greatest(F.col("block") * block, "start") - F.col("start")).alias("first"),
            (F.least((F.col("block") + 1) * block, "end") - F.col("start")).alias("last"),
        )
        .groupBy("source_no", "shard", "start")
        .agg(
            F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"),
            F.sum(F.col("last") - F.col("first")).alias("extra"),
        )
    )
    # A text without words starts where its follower starts; it gets no spans.
    key = F.when(F.col("size") > 0, F.col("start"))
    return (
        placed.withColumn("_start", key)
        .join(
            pieces.withColumnRenamed("start", "_start").hint("merge"),
            ["source_no", "shard", "_start"],
            "left",
        )
        .select(
            "doc_id", "source", "size", "source_size", "target",
            F.coalesce("passes", F.lit(0)).cast("long").alias("passes"),
            F.coalesce("spans", F.expr("cast(array() as array<struct<first: bigint, last: bigint>>)")).alias("spans"),
            (F.coalesce("passes", F.lit(0)) * F.col("size") + F.coalesce("extra", F.lit(0)))
            .cast("long").alias("taken"),
        )
    )


def materialise(docs: DataFrame, taken: DataFrame) -> DataFrame:
    """The rows of the mix: one copy of the document per whole pass, and one with the
    words of its spans, joined by one space. Columns as in ``docs``; ``n_chars`` follows
    the text if there is such a column. Rows of ``docs`` that agree in doc_id, source and
    size (by a 64-bit hash) share the mix's rows in any order."""
    doc = F.col("_doc")
    here = docs.select(F.struct("*").alias("_doc")).select(
        "_doc",
        F.xxhash64(doc.doc_id, doc.source.cast("string"), word_count(doc.text)).alias("_key"),
    )
    numbered = Window.partitionBy("_key")
    here = here.withColumn("_no", F.row_number().over(numbered.orderBy(F.col("_doc.text"))))
    there = taken.where("taken > 0").select(
        F.xxhash64("doc_id", "source", "size").alias("_key"), "passes", "spans"
    )
    there = there.withColumn("_row", F.row_number().over(numbered.orderBy("passes", "spans")))
    # The numbers are compared as a difference, which leaves the key alone to join by: the
    # texts stay where numbering has put them and are shuffled once.
    match = (here["_key"] == there["_key"]) & ((F.col("_no") - F.col("_row")) == 0)
    partial = F.col("_copy") == F.col("passes")
    last = F.col("passes") - F.when(F.size("spans") > 0, 0).otherwise(1)
    cut = F.transform(
        "spans",
        lambda s: F.slice(F.col("_words"), (s.first + 1).cast("int"), (s.last - s.first).cast("int")),
    )
    rows = (
        here.join(there, match)
        .select("_doc", "passes", "spans", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_copy"))
        .withColumn("_words", F.when(partial, words(F.col("_doc.text"))))
        .withColumn("_text", F.when(partial, F.array_join(F.flatten(cut), " ")).otherwise(doc.text))
    )
    new = {"text": F.col("_text"), "n_chars": F.char_length("_text")}
    return rows.select(
        *[new.get(c, doc[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns]
    )
