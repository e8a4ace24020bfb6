"""Metric relabelling over MAP<STRING, STRING> label columns."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.once import let, once


@dataclass(frozen=True)
class Rule:
    action: str = "replace"  # replace, keep, drop, labelmap
    source: Sequence[str] = ()
    regex: str = "(.*)"
    target: str = ""
    replacement: str = "$1"
    separator: str = ";"


def _anchored(regex: str) -> str:
    return rf"(?s)\A(?:{regex})\z"


def _java_replacement(replacement: str) -> str:
    return re.sub(r"\$\{(\d+)\}", r"$\1", replacement)


class _Labels:
    """Label lookups of a frame: labels that rules write are columns while rules run, so the
    map itself is rebuilt once and not by every rule."""

    def __init__(self, column: str, written: Sequence[str]):
        self.map = F.col(column)
        self.columns = {name: f"_label_{i}" for i, name in enumerate(written)}

    def get(self, name: str) -> Column:
        return F.col(self.columns[name]) if name in self.columns else self.map[name]

    def joined(self, rule: Rule) -> Column:
        parts = [F.coalesce(self.get(s), F.lit("")) for s in rule.source]
        return F.concat_ws(rule.separator, *parts) if parts else F.lit("")

    def opened(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.map[n] for n, c in self.columns.items()})

    def closed(self) -> Column:
        """The map with all written labels in it; absent ones are left out."""
        names = list(self.columns)
        others = F.map_filter(self.map, lambda name, _: ~name.isin(*names))
        written = F.map_from_arrays(
            F.array(*map(F.lit, names)), F.array(*map(F.col, self.columns.values()))
        )
        return F.map_concat(others, F.map_filter(written, lambda _, value: value.isNotNull()))


def _replaced(labels: _Labels, rule: Rule) -> Column:
    """New value of the target where the source matches; an empty one removes the label."""
    joined, pattern = labels.joined(rule), _anchored(rule.regex)
    replacement = _java_replacement(rule.replacement)
    everything = rule.regex == "(.*)"
    if "$" not in replacement:
        value = F.lit(replacement)
    elif everything and replacement == "$1":
        value = joined
    else:
        value = F.regexp_replace(joined, pattern, replacement)
    value = F.nullif(value, F.lit(""))
    return value if everything else F.when(joined.rlike(pattern), value).otherwise(
        labels.get(rule.target)
    )


def _mapped(labels: Column, rule: Rule) -> Column:
    """Copy the labels whose name matches to the rewritten name."""
    pattern, replacement = _anchored(rule.regex), _java_replacement(rule.replacement)
    copied = F.transform_keys(
        F.map_filter(labels, lambda name, _: name.rlike(pattern)),
        lambda name, _: F.regexp_replace(name, pattern, replacement),
    )

    def merged(new: Column) -> Column:
        kept = F.map_filter(labels, lambda name, _: ~F.map_contains_key(new, name))
        return F.map_concat(kept, new)

    return let(copied, merged)


def relabel(df: DataFrame, rules: Sequence[Rule], labels: str = "labels") -> DataFrame:
    """Apply the rules in order; `keep` and `drop` filter rows, the others edit the map."""
    written = list(dict.fromkeys(r.target for r in rules if r.action == "replace"))
    state = _Labels(labels, written)
    df = state.opened(df)
    for rule in rules:
        matched = state.joined(rule).rlike(_anchored(rule.regex))
        if rule.action == "keep":
            df = df.filter(matched)
        elif rule.action == "drop":
            df = df.filter(~matched)
        elif rule.action == "replace":
            df = df.withColumn(state.columns[rule.target], _replaced(state, rule))
        elif rule.action == "labelmap":
            df = once(df, **{labels: state.closed()})
            df = state.opened(once(df, **{labels: _mapped(F.col(labels), rule)}))
        else:
            raise ValueError(f"unknown relabel action: {rule.action!r}")
    return once(df, **{labels: state.closed()}).drop(*state.columns.values())
