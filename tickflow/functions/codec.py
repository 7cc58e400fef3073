"""JSON messages to rows and back, tolerant the way the tick jobs need it.

Two error levels are kept apart. A message that is not a JSON object is skipped;
a field that is missing or does not fit its type is null. A typed ``from_json``
cannot tell these apart, so every field is first read as text next to a
corrupt-record column, then converted with ``try_cast``.

Each parse goes through a generator (``inline``): a filter on the parsed columns
cannot be pushed below a generator, so a message is parsed once. The same filter
over a plain projection would be copied below it and parse the text again. The test
for blank messages stands inside the generator too, where it cannot be pushed below
the projection that made the message and make it a second time.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tickflow.functions.accounting import Account

_CORRUPT = "_corrupt"
# Lenient about fields, strict about what JSON is.
_LENIENT = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _CORRUPT,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


def _as_text(fields: Iterable[StructField]) -> list[StructField]:
    return [StructField(f.name, StringType()) for f in fields]


def _typed(fields: Iterable[StructField]) -> list[Column]:
    return [
        F.col(f.name) if isinstance(f.dataType, StringType)
        else F.col(f.name).try_cast(f.dataType).alias(f.name)
        for f in fields
    ]


def decode_json(
    messages: DataFrame,
    schema: StructType,
    columns: Iterable[str] | None = None,
    value: str = "value",
    keep: Iterable[str] = (),
    account: Account | None = None,
) -> DataFrame:
    """Decode one JSON object per message into the columns of ``schema``.

    ``columns`` narrows the decoded fields (Spark does not narrow a lenient
    ``from_json`` by itself); ``keep`` carries other columns of ``messages`` along;
    ``account`` counts what is left out.
    """
    wanted = None if columns is None else set(columns)
    fields = [f for f in schema.fields if wanted is None or f.name in wanted]
    text = StructType(_as_text(fields) + [StructField(_CORRUPT, StringType())])
    keep = list(keep)
    filled = F.when(F.col(value).rlike(r"\S"), F.array(F.from_json(value, text, _LENIENT)))
    if account is not None:
        messages = account.read(messages)
    parsed = messages.select(*keep, F.inline(filled))
    if account is not None:
        parsed = account.parsed(parsed, fields, _CORRUPT)
    return parsed.where(F.col(_CORRUPT).isNull()).select(*keep, *_typed(fields))


def decode_listing(
    payloads: DataFrame, schema: StructType, value: str = "value", keep: Iterable[str] = ()
) -> DataFrame:
    """Rows of a JSON array payload, with their ``position`` in the array."""
    keep = list(keep)
    rows = payloads.select(*keep, F.posexplode(F.from_json(value, ArrayType(schema))))
    return rows.select(*keep, F.col("pos").alias("position"), "col.*")


def decode_first(
    payloads: DataFrame, schema: StructType, value: str = "value", keep: Iterable[str] = ()
) -> DataFrame:
    """The first object of each JSON array payload; nothing for an empty array."""
    keep = list(keep)
    text = ArrayType(StructType(_as_text(schema.fields)))
    first = F.slice(F.from_json(value, text), 1, 1)
    return payloads.select(*keep, F.inline(first)).select(*keep, *_typed(schema.fields))


def open_objects(payloads: DataFrame, first: bool, value: str = "value", keep: Iterable[str] = ()) -> DataFrame:
    """``fields``, the JSON object of each message with all its fields as they came; with
    ``first`` the first object of each JSON array. What is no such thing is skipped."""
    keep = list(keep)
    if first:
        opened = F.slice(F.from_json(value, "array<map<string, variant>>"), 1, 1)
    else:
        opened = F.array(F.from_json(value, "map<string, variant>"))
    found = payloads.select(*keep, F.explode(opened).alias("fields"))
    return found.where(F.col("fields").isNotNull())


def text_field(fields: str, name: str) -> Column:
    """A field of an opened object as text; null if it is missing or an object."""
    return F.try_variant_get(F.try_element_at(F.col(fields), F.lit(name)), "$", "string")


def close_object(fields: str, name: str, value: Column) -> Column:
    """The opened object as a message again, with the text field ``name`` set to ``value``."""
    others = F.map_filter(F.col(fields), lambda key, _: key != name)
    added = F.create_map(F.lit(name), value.cast("string").cast("variant"))
    return F.to_json(F.map_concat(others, added), {"ignoreNullFields": "false"})


def encode_json(rows: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One JSON object per row as the only column ``value``; nulls are written."""
    columns = rows.columns if columns is None else list(columns)
    return rows.select(
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value")
    )
