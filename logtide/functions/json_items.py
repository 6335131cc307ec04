"""JSON parse, item access, key overwrite and serialisation of open items."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logtide.schemas import (
    CORRUPT_COLUMN,
    ITEM_AREA_KEY,
    ITEM_DT_KEY,
    JSON_OPTIONS,
    RAW_LOG_SCHEMA,
)


def parse_raw_log(value: Column) -> Column:
    """Text -> struct(dt, countryCode, data ARRAY<MAP<STRING,VARIANT>>, _corrupt_record).

    Bad text, a non-object, a wrongly typed ``data`` and a non-object element all
    fill ``_corrupt_record``; null or empty text gives a NULL struct.
    """
    return F.from_json(value, RAW_LOG_SCHEMA, JSON_OPTIONS)


def one_json_value(value: Column) -> Column:
    """True when the text is one JSON value and nothing else; text after it makes this false.

    The parser stops after the first value, so the text is read inside two wrappings: as the only
    element of an array and as the only field of an object. What follows the value must start with what
    closes its wrapping to go unnoticed, and no text starts with both brackets. Elements and keys are only
    counted, so neither reading builds values.

    One reading says it all where the text holds no closing bracket of its kind that could follow the value:
    no ``]`` at all, or, in a text that starts an object, no two ``}`` in a row.
    """
    elements = F.json_array_length(F.concat(F.lit("["), value, F.lit("]"))) == 1
    fields = F.size(F.json_object_keys(F.concat(F.lit('{"v":'), value, F.lit("}")))) == 1
    one = (F.when(~F.contains(value, F.lit("]")), elements)
           .when(value.rlike(r"^\s*\{") & ~value.rlike(r"\}\s*\}"), fields)
           .otherwise(elements & fields))
    return F.coalesce(one, F.lit(False))


def last_value_wins(item: Column) -> Column:
    """The item with one entry per key: of a repeated key the last value (JSON allows repeats)."""
    keys = F.map_keys(item)
    entries = F.map_entries(item)
    last = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]))
    return F.when(F.size(keys) == F.size(F.array_distinct(keys)), item).otherwise(F.map_from_entries(last))


def has_null_item(items: Column) -> Column:
    return F.exists(items, lambda m: m.isNull())


def quarantine_reason(rec: Column, value: Column) -> Column:
    """Why a parsed raw log cannot be cleaned; NULL when it can."""
    return (
        F.when(rec.isNull(), F.lit("empty"))
        .when(rec[CORRUPT_COLUMN].isNotNull() | ~one_json_value(value), F.lit("malformed"))
        .when(rec["data"].isNull(), F.lit("missing_data"))
        .when(has_null_item(rec["data"]), F.lit("null_item"))
    )


def item_string(item: Column, key: str) -> Column:
    """Item value as text (numbers become their text), NULL when absent or JSON null."""
    return F.try_variant_get(item[key], "$", "string")


def item_double(item: Column, key: str) -> Column:
    return F.try_variant_get(item[key], "$", "double")


def set_item_keys(item: Column, area: Column, dt: Column) -> Column:
    """Put area and dt on the item, overwriting keys of the same name; other keys stay, without those that are null."""
    keep = F.map_filter(
        item,
        lambda k, v: (~k.isin(ITEM_AREA_KEY, ITEM_DT_KEY)) & v.isNotNull() & (~F.is_variant_null(v)),
    )
    area_v, dt_v = area.cast("variant"), dt.cast("variant")
    both = F.create_map(F.lit(ITEM_AREA_KEY), area_v, F.lit(ITEM_DT_KEY), dt_v)
    added = (F.when(area.isNotNull() & dt.isNotNull(), both)
             .when(area.isNotNull(), F.create_map(F.lit(ITEM_AREA_KEY), area_v))
             .when(dt.isNotNull(), F.create_map(F.lit(ITEM_DT_KEY), dt_v))
             .otherwise(F.create_map().cast("map<string,variant>")))
    return F.map_concat(keep, added)


# A JSON string from quote to quote; possessive, so that long ones need no stack.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
# A key with a null value and the comma before it; or a whole string, kept, so that nothing inside one is taken for a key.
_NULL_KEY = rf"(?s),?{_STRING}:null(?=[,}}])|({_STRING})"
# The comma that a first key leaves behind; or a whole string, kept.
_FIRST_COMMA = rf"(?s)(?<=\{{),|({_STRING})"


def drop_null_keys(text: Column) -> Column:
    """JSON text without whitespace, without keys whose value is null, at any depth; nulls in arrays stay."""
    bare = F.regexp_replace(F.regexp_replace(text, _NULL_KEY, "$1"), _FIRST_COMMA, "$1")
    return F.when(F.contains(text, F.lit(":null")), bare).otherwise(text)
