"""Severity of a record, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.functions.once import let
from logloom.functions.values import is_number, kind, text

# Level keys in order of preference, spellings, numeric levels, defaults.
LEVEL_KEYS = ("level", "severity", "loglevel", "log_level", "lvl")
SPELLINGS = {
    1: ("trace", "TRACE", "Trace"),
    5: ("debug", "DEBUG", "Debug", "dbg", "DBG"),
    9: ("info", "INFO", "Info", "information", "INFORMATION"),
    13: ("warn", "WARN", "Warn", "warning", "WARNING", "Warning"),
    17: ("error", "ERROR", "Error", "err", "ERR"),
    21: ("fatal", "FATAL", "Fatal", "critical", "CRITICAL", "Critical", "crit", "CRIT"),
}
SYSLOG = {24: (0, 1), 21: (2,), 17: (3,), 13: (4,), 9: (5, 6), 5: (7,)}
DEFAULT_NUMBER, DEFAULT_TEXT = 9, "Info"
UNIFIED = {
    "INFO": ("I", "INF", "INFO"),
    "WARN": ("W", "WRN", "WARN", "WARNING"),
    "ERR": ("E", "ERR", "ERROR", "EROR"),
    "DBG": ("D", "DBG", "DEBUG"),
    "NOTICE": ("N", "NOTICE"),
    "FATAL": ("F", "FATAL"),
}


def _choose(value: Column, table: dict, default: Column) -> Column:
    cases = [(value.isin(*members), result) for result, members in table.items()]
    chosen = F.when(cases[0][0], F.lit(cases[0][1]))
    for condition, result in cases[1:]:
        chosen = chosen.when(condition, F.lit(result))
    return chosen.otherwise(default)


def severity_of_text(level: Column) -> Column:
    return _choose(level, SPELLINGS, F.lit(DEFAULT_NUMBER))


def severity_of_number(level: Column) -> Column:
    return _choose(level, SYSLOG, F.lit(DEFAULT_NUMBER))


def severity_of(fields: Column) -> Column:
    """STRUCT<number, text> of the first usable level key of a record."""

    def pair(number: Column, label: Column) -> Column:
        return F.struct(number.cast("int").alias("number"), label.alias("text"))

    def usable(value: Column) -> Column:
        return F.when((kind(value) == "STRING") | is_number(kind(value)), value)

    def of_number(level: Column) -> Column:
        return pair(severity_of_number(level), level.cast("string"))

    def of_level(value: Column) -> Column:
        whole = F.try_variant_get(value, "$", "double").cast("bigint")
        return F.when(
            kind(value) == "STRING",
            let(text(value), lambda level: pair(severity_of_text(level), level)),
        ).otherwise(let(whole, of_number))

    first = F.coalesce(*(usable(fields[key]) for key in LEVEL_KEYS))
    default = pair(F.lit(DEFAULT_NUMBER), F.lit(DEFAULT_TEXT))
    return let(first, lambda v: F.when(v.isNull(), default).otherwise(of_level(v)))


def unify_severity(severity: Column) -> Column:
    """Common short spellings to one form; anything else stays as it is."""
    space = r"^[\s\x{85}\p{Z}]+|[\s\x{85}\p{Z}]+$"
    return _choose(F.upper(F.regexp_replace(severity, space, "")), UNIFIED, severity)
