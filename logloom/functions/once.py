"""Expressions that must not be copied around by the optimizer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns that are computed one time per row.

    Catalyst moves filters below a projection by copying the column's expression into them; a
    parsed record used by several later columns would then be parsed again for each. A filter
    does not move below a generator, so the columns are the fields of a one-row `inline`.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    made = F.struct(*(c.alias(n) for n, c in columns.items()))
    return df.select(*kept, F.inline(F.array(made)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed one time, for use inside a larger expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
