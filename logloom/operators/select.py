"""Selection and counting of stored logs, as filters to chain on a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.patterns import captured, has_word, matches


def at(df: DataFrame, moment: str, ts: str = "ts") -> Column:
    """A literal of the type of the time column, so the comparison reaches the file scan."""
    return F.lit(moment).cast(df.schema[ts].dataType)


def last_hours(df: DataFrame, asof: str, hours: int, ts: str = "ts") -> DataFrame:
    """Rows of the `hours` before `asof`."""
    end = at(df, asof, ts)
    start = end - F.make_dt_interval(hours=F.lit(hours))
    return df.filter((F.col(ts) > start) & (F.col(ts) <= end))


def field_is(df: DataFrame, name: str, value: str) -> DataFrame:
    return df.filter(F.col(name) == value)


def field_matches(df: DataFrame, name: str, pattern: str) -> DataFrame:
    return df.filter(matches(F.col(name), pattern))


def field_has(df: DataFrame, name: str, phrase: str) -> DataFrame:
    """Whole words: `dev-1` does not find `dev-10`."""
    return df.filter(has_word(F.col(name), phrase))


def message_has(df: DataFrame, phrase: str, body: str = "body") -> DataFrame:
    return field_has(df, body, phrase)


def stream_is(df: DataFrame, **labels: str) -> DataFrame:
    for name, value in labels.items():
        df = field_is(df, name, value)
    return df


def first(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The `limit` pipe, ordered so that the result is always the same."""
    return df.orderBy(*order).limit(n)


def extract(df: DataFrame, pattern: str, source: str, *names: str) -> DataFrame:
    """Named groups of `pattern` as columns; '' where it does not match."""
    return df.withColumns(
        {n: F.coalesce(captured(F.col(source), pattern, n), F.lit("")) for n in names}
    )


def count_rows(df: DataFrame, name: str = "count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def count_unique(df: DataFrame, column: str, *by: str, approximate: bool = False) -> DataFrame:
    """Distinct non-empty values, so a record delivered twice counts once."""
    filled = F.nullif(F.col(column), F.lit(""))
    distinct = F.approx_count_distinct(filled) if approximate else F.count_distinct(filled)
    return df.groupBy(*by).agg(distinct.alias("unique"))


def reconcile(expected: DataFrame, delivered: DataFrame) -> DataFrame:
    """Expected against delivered per namespace; `complete` is false where some are missing."""
    counts = delivered.groupBy("namespace").agg(F.count(F.lit(1)).alias("n"))
    return expected.join(counts, "namespace", "left").select(
        "namespace", "expected", F.coalesce("n", F.lit(0)).alias("delivered"),
        (F.coalesce("n", F.lit(0)) >= F.col("expected")).alias("complete"),
    )


def unique_sketches(df: DataFrame, column: str, *by: str, ts: str = "ts", lg_k: int = 12) -> DataFrame:
    """Mergeable sketches of the distinct non-empty values, per hour and `by`: `hour`, `by`, `sketch`.

    A sketch has at most 2^`lg_k` small registers, whatever it counts.
    """
    filled = F.nullif(F.col(column), F.lit(""))
    hour = F.date_trunc("hour", F.col(ts).cast("timestamp")).cast(df.schema[ts].dataType)
    return df.groupBy(hour.alias("hour"), *by).agg(F.hll_sketch_agg(filled, lg_k).alias("sketch"))


def unique_in(sketches: DataFrame, since: str, until: str, *by: str) -> DataFrame:
    """Estimated distinct values of the hours in [`since`, `until`), from sketches alone.

    The relative standard error is about 0.8 / sqrt(2^lg_k): 1.3 % for the default.
    """
    hours = sketches.filter((F.col("hour") >= at(sketches, since, "hour")) & (
        F.col("hour") < at(sketches, until, "hour")))
    return hours.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique"))
