"""Helpers over VARIANT values and the MAP<STRING, VARIANT> record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BODY_LIMIT = 1024


def kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def string_of(value: Column) -> Column:
    """The value if it is a string, else NULL."""
    return F.when(kind(value) == "STRING", text(value))


def is_number(value_kind: Column) -> Column:
    return value_kind.isin("BIGINT", "DOUBLE", "FLOAT") | value_kind.startswith("DECIMAL")


def record_fields(record: Column) -> Column:
    """Top level of a VARIANT record; NULL when it is not an object."""
    return F.try_variant_get(record, "$", "map<string,variant>")


def put(fields: Column, key: str, value: Column) -> Column:
    """Set one key; a NULL value leaves the record as it is."""
    kept = F.map_filter(fields, lambda k, _: k != key)
    return F.when(
        value.isNotNull(), F.map_concat(kept, F.create_map(F.lit(key), value.cast("variant")))
    ).otherwise(fields)


def html_safe(json: Column) -> Column:
    r"""`<`, `>` and `&` as \u escapes, the way the shipped JSON encoder writes them."""
    for char, code in (("<", r"\u003c"), (">", r"\u003e"), ("&", r"\u0026")):
        json = F.replace(json, F.lit(char), F.lit(code))
    return json


def cut_bytes(value: Column, limit: int = BODY_LIMIT) -> Column:
    """First `limit` bytes plus a note of how many were cut; short text is untouched."""
    size = F.octet_length(value)
    head = F.make_valid_utf8(F.substring(value.cast("binary"), 1, limit).cast("string"))
    return F.when(
        size > limit,
        F.concat(head, F.lit("... <truncated "), (size - limit).cast("string"), F.lit(" bytes>")),
    ).otherwise(value)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))
