"""Regular expressions and globs in the form Spark's Java engine reads the same way."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def java_regex(pattern: str) -> str:
    """RE2 syntax to Java: named groups, end of text, `.` stopping at newline only."""
    pattern = pattern.replace("(?P<", "(?<")
    # an escaped sign and a character class stay; each other `$` is the very end
    parts = re.compile(r"\\.|\[\^?\]?(?:\\.|\[:\w+:\]|[^\]\\])*\]|\$", re.S)
    return "(?d)" + parts.sub(lambda m: r"\z" if m[0] == "$" else m[0], pattern)


def matches(column: Column, pattern: str) -> Column:
    """Unanchored match."""
    return column.rlike(java_regex(pattern))


def captured(column: Column, pattern: str, group: int | str) -> Column:
    """Submatch by number or name; NULL where the pattern does not match."""
    if isinstance(group, str):
        group = re.compile(pattern).groupindex[group]
    java = java_regex(pattern)
    return F.when(column.rlike(java), F.regexp_extract(column, java, group))


def glob_regex(glob: str) -> str:
    """`*` and `?` wildcards, anchored on both sides."""
    body = "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in glob)
    return rf"\A{body}\z"


def tag_matches(tag: Column, glob: str) -> Column:
    return F.lit(True) if glob == "*" else tag.rlike(glob_regex(glob))


def has_word(column: Column, word: str) -> Column:
    """Whole word or phrase: no word character may touch it on either side."""
    sign = r"[\p{L}\p{M}\p{N}_]"
    return column.rlike(rf"(?<!{sign}){re.escape(word)}(?!{sign})")


def redact_credentials(endpoint: Column) -> Column:
    return F.regexp_replace(endpoint, "//.*@", "//xxxxx@")
