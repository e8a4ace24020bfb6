"""Label selectors over MAP<STRING, STRING>."""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_NAME = r"[A-Za-z0-9]([-A-Za-z0-9_./]*[A-Za-z0-9])?"
_SET = re.compile(rf"({_NAME})\s+(in|notin)\s*\(([^()]*)\)")
_SIZE = re.compile(rf"({_NAME})\s*([<>])\s*(-?[0-9]+)")
_PAIR = re.compile(rf"({_NAME})\s*(==|=|!=)\s*({_NAME})?")
_KEY = re.compile(rf"(!?)\s*({_NAME})")


def _one(labels: Column, key: str, operator: str, values: list[str]) -> Column:
    present, value = F.map_contains_key(labels, F.lit(key)), labels[key]
    if operator == "exists":
        return present
    if operator == "absent":
        return ~present
    if operator in "<>":
        number, bound = value.try_cast("bigint"), int(values[0])
        hit = number < bound if operator == "<" else number > bound
        return present & F.coalesce(hit, F.lit(False))
    hit = present & value.isin(*values)
    return hit if operator == "in" else ~F.coalesce(hit, F.lit(False))


def _requirement(term: str) -> tuple[str, str, list[str]]:
    if found := _SET.fullmatch(term):
        return found[1], found[3], [v.strip() for v in found[4].split(",")]
    if found := _SIZE.fullmatch(term):
        return found[1], found[3], [found[4]]
    if found := _PAIR.fullmatch(term):
        return found[1], "notin" if found[3] == "!=" else "in", [found[4] or ""]
    if found := _KEY.fullmatch(term):
        return found[2], "absent" if found[1] else "exists", []
    raise ValueError(f"bad label selector term: {term!r}")


def _from_json(selector: str) -> list[tuple[str, str, list[str]]]:
    spec = json.loads(selector)
    terms = [(k, "in", [v]) for k, v in (spec.get("matchLabels") or {}).items()]
    names = {"In": "in", "NotIn": "notin", "Exists": "exists", "DoesNotExist": "absent"}
    for rule in spec.get("matchExpressions") or []:
        if rule.get("operator") not in names:
            raise ValueError(f"bad selector operator: {rule.get('operator')!r}")
        operator, values = names[rule["operator"]], rule.get("values") or []
        if (operator in ("in", "notin")) != bool(values):
            raise ValueError(f"selector values do not fit the operator: {rule!r}")
        terms.append((rule["key"], operator, values))
    return terms


def label_selector(labels: Column, selector: str) -> Column:
    """`k=v`, `k!=v`, `k in (a,b)`, `k notin (a)`, `k`, `!k`, `k>1`, `k<1` by commas, or JSON."""
    if not selector.strip():
        return F.lit(True)
    if selector.startswith("{"):
        terms = _from_json(selector)
    else:
        terms = [_requirement(t.strip()) for t in re.split(r",(?![^()]*\))", selector)]
    return reduce(Column.__and__, (_one(labels, *t) for t in terms), F.lit(True))
