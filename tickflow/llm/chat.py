"""Chat formatting: every assistant turn becomes one training example.

An example holds all turns before the reply as context, then the reply, and only the
reply's text is trainable (``loss_start`` to ``loss_end``, in code points of ``text``).
Turns after the last reply are nobody's context; they come out as one more example
without a trainable part, so the output holds every turn.

Template: ``<s>role[INST]text</s>`` per turn. A control string inside a role or a text
gets a tilde after its first character (``</s>`` becomes ``<~/s>``), and one that has
tildes there already gets one more, which can be undone exactly: see ``escape`` and
``unescape``.

The conversation is the unit: its turns are gathered by one shuffle, ordered by
(turn, role, text), and the examples are cut from the joined turns. Exploding them keeps
the partitioning, so grouping examples by conversation again needs no second shuffle.
Everything is DataFrame code.

Null texts and roles are empty; a null conversation id is a conversation. Repeated rows
are separate turns; ties of ``turn`` are ordered by role, then text. An empty table gives
no examples. Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, TEXT, END = "<s>", "[INST]", "</s>"
# The control strings, with any number of tildes after the first character.
CONTROL = r"([<\[])(~*)(/?(?:s>|INST\]))"
ESCAPED = r"([<\[])~(~*)(/?(?:s>|INST\]))"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, "$1~$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def examples(turns: DataFrame, reply: str = ASSISTANT) -> DataFrame:
    """Columns: conv_id, ``example`` (0 and up), ``text``, ``loss_start``, ``loss_end``
    (equal if nothing is trainable)."""
    clean = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    gathered = (
        turns.select("conv_id", "turn", clean("role").alias("role"), clean("text").alias("text"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("_turns"))
    )
    piece = lambda t: F.concat(
        F.lit(START), escape(t.role), F.lit(TEXT), escape(t.text), F.lit(END)
    )
    pieces = gathered.select(
        "conv_id",
        F.transform("_turns", piece).alias("_pieces"),
        F.transform("_turns", lambda t: t.role == reply).alias("_replies"),
        F.transform("_turns", lambda t: F.char_length(escape(t.text))).alias("_lengths"),
    )
    # The number of turns in each example: up to and with a reply, or all of them if the
    # last turn is not one.
    upto = F.filter(
        F.sequence(F.lit(1), F.size("_replies")),
        lambda i: F.get("_replies", i - 1) | (i == F.size("_replies")),
    )
    joined = pieces.select("*", F.posexplode(upto).alias("example", "_upto")).withColumn(
        "text", F.array_join(F.slice("_pieces", F.lit(1), F.col("_upto")), "")
    )
    end = F.char_length("text") - len(END)
    is_reply = F.get("_replies", F.col("_upto") - 1)
    start = F.when(is_reply, F.col("loss_end") - F.get("_lengths", F.col("_upto") - 1))
    return joined.withColumn("loss_end", end).select(
        "conv_id", "example", "text",
        F.coalesce(start, F.col("loss_end")).alias("loss_start"), "loss_end",
    )


def read_turns(text: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    bodies = F.filter(F.split(text, END, -1), lambda p: p != "")
    return F.transform(
        bodies,
        lambda p: F.struct(
            unescape(F.substring_index(F.substr(p, F.lit(len(START) + 1)), TEXT, 1)).alias("role"),
            unescape(F.substr(p, F.instr(p, F.lit(TEXT)) + len(TEXT))).alias("text"),
        ),
    )


def read_back(made: DataFrame) -> DataFrame:
    """Per conversation, from its examples alone: ``turns`` (role, text), ``loss`` (the
    trainable texts in order, joined by nothing) and ``formatted_chars`` (of all examples)."""
    trained = unescape(
        F.substr("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    )
    # The last example holds all turns; of the others only the reply is carried on.
    return (
        made.withColumn("_trained", trained)
        .groupBy("conv_id")
        .agg(
            F.max_by("text", "example").alias("_last"),
            F.sort_array(F.collect_list(F.struct("example", "_trained"))).alias("_parts"),
            F.sum(F.char_length("text")).cast("long").alias("formatted_chars"),
        )
        .select(
            "conv_id",
            read_turns(F.col("_last")).alias("turns"),
            F.array_join(F.transform("_parts", lambda p: p["_trained"]), "").alias("loss"),
            "formatted_chars",
        )
    )
