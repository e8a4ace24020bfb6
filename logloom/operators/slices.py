"""Ordered windows over keys of any size.

A plain window puts a whole key into one task. That is what happens if no key has more than `ROWS`
rows, which is counted first. Beyond, a key is cut into slices of time that hold at most `ROWS` each: spans of the given width, and shorter ones where rows were counted to be
denser. Each slice is one window group, and what a slice needs from earlier ones comes from a
summary with one row per key and slice. Keys are never NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions.values import micros
from logloom.session import settle

HOUR = 3_600_000_000
DAY = 24 * HOUR


def slice_of(ts: Column, width: int) -> Column:
    return slice_of_micros(micros(ts), width)


def slice_of_micros(at: Column, width: int) -> Column:
    return ((at - F.pmod(at, F.lit(width))) / width).cast("bigint")


ROWS = 1_000_000
SECOND, MINUTE = 1_000_000, 60_000_000


def measured(df: DataFrame, keys: list[str]) -> tuple[DataFrame, bool]:
    """`df`, computed once, and whether each of its keys is few enough rows for one window group."""
    df = settle(df)
    largest = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    return df, (largest or 0) <= ROWS


def cut(
    df: DataFrame, keys: list[str], ts: str, width: int, rows: int | None = None, settled: bool = False
) -> DataFrame:
    """Add `_slice`, the first microsecond of a row's slice.

    Rows are counted by key and span of `width`. If any has too many, they are counted by second: such
    a span is cut into minutes, such a minute into seconds, such a second into its moments. Spans that are too dense number at most
    the rows over `rows`, so their table is broadcast. The input is computed once and kept in the
    shared folder (unless it is `settled` already), for it is read to count, to sum up and to order.
    """
    df, rows = df if settled else settle(df), rows or ROWS
    at = micros(F.col(ts))
    minute_size, second_size = min(MINUTE, width), min(SECOND, width)

    def start(moment: Column, size: int) -> Column:
        return moment - F.pmod(moment, F.lit(size))

    largest = df.groupBy(*keys, start(at, width).alias("_span")).agg(
        F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    if (largest or 0) <= rows:
        return df.withColumn("_slice", start(at, width))
    counts = df.groupBy(*keys, start(at, second_size).alias("_second")).agg(
        F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumns({"_span": start(F.col("_second"), width),
                                 "_minute": start(F.col("_second"), minute_size)})
    in_span = F.sum("_n").over(Window.partitionBy(*keys, "_span"))
    in_minute = F.sum("_n").over(Window.partitionBy(*keys, "_span", "_minute"))
    dense = counts.withColumn("_all", in_span).filter(F.col("_all") > rows).withColumn(
        "_some", in_minute).groupBy(*keys, "_span").agg(
        F.collect_set(F.when(F.col("_some") > rows, F.col("_minute"))).alias("_minutes"),
        F.collect_set(F.when(F.col("_n") > rows, F.col("_second"))).alias("_seconds"))
    dense = F.broadcast(dense.withColumnsRenamed({k: f"_dense_{k}" for k in [*keys, "_span"]}))
    own = df.withColumn("_span", start(at, width))
    same = [F.col(k) == F.col(f"_dense_{k}") for k in [*keys, "_span"]]
    chosen = (
        F.when(F.col("_minutes").isNull(), F.col("_span"))
        .when(~F.array_contains("_minutes", start(at, minute_size)), start(at, minute_size))
        .when(~F.array_contains("_seconds", start(at, second_size)), start(at, second_size))
        .otherwise(at))
    return own.join(dense, same, "left").withColumn("_slice", chosen).select(*df.columns, "_slice")


def _with_carry(
    sliced: DataFrame, keys: list[str], summary: DataFrame, spec: dict[str, Column]
) -> DataFrame:
    """Attach to every row what the other slices of its key contribute.

    The rows are partitioned by (keys, slice) for this join, and stay so for the window after.
    """
    carry = summary.select(*keys, "_slice", *(c.alias(n) for n, c in spec.items()))
    return sliced.join(carry, [*keys, "_slice"], "left")


def neighbour(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: dict[str, str],
    ahead: bool = False,
    width: int = HOUR,
) -> DataFrame:
    """Values of the previous (or next) row of the same key; `order` starts with the time.

    `columns` maps a source column to the name its neighbour value gets.
    """
    df, small = measured(df, keys)
    shift = F.lead if ahead else F.lag
    if small:
        whole = Window.partitionBy(*keys).orderBy(*order)
        return df.select(*df.columns, *(shift(c).over(whole).alias(n) for c, n in columns.items()))
    sliced = cut(df, keys, order[0], width, settled=True)
    position, row = F.struct(*order), F.struct(*columns)
    edge = F.min_by(row, position) if ahead else F.max_by(row, position)
    summary = sliced.groupBy(*keys, "_slice").agg(edge.alias("_edge"))
    across = Window.partitionBy(*keys).orderBy("_slice")
    joined = _with_carry(sliced, keys, summary, {"_carry": shift("_edge").over(across)})
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    near = F.coalesce(shift(row).over(inside), F.col("_carry"))
    return joined.withColumn("_near", near).select(
        *df.columns, *(F.col("_near")[c].alias(n) for c, n in columns.items())
    )


_COMBINE = {"sum": F.sum, "max": F.max}


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    totals: dict[str, tuple[str, Column]],
    width: int = HOUR,
) -> DataFrame:
    """Running `sum` or `max` per key over all rows up to and including the current one.

    `totals` maps an output name to (`"sum"` or `"max"`, column). Rows must be distinct in
    `order`.
    """
    df, small = measured(df, keys)
    if small:
        whole = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select(*df.columns, *(
            _COMBINE[how](c).over(whole).alias(n) for n, (how, c) in totals.items()))
    sliced = cut(df, keys, order[0], width, settled=True)
    summary = sliced.groupBy(*keys, "_slice").agg(
        *(_COMBINE[how](c).alias(f"_part_{n}") for n, (how, c) in totals.items())
    )
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carry = {
        f"_carry_{n}": _COMBINE[how](f"_part_{n}").over(before)
        for n, (how, _) in totals.items()
    }
    joined = _with_carry(sliced, keys, summary, carry)
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0
    )

    def total(name: str, how: str, column: Column) -> Column:
        here, carried = _COMBINE[how](column).over(inside), F.col(f"_carry_{name}")
        if how == "max":
            return F.greatest(here, carried)
        return F.coalesce(here + carried, here, carried)

    return joined.select(*df.columns, *(total(n, *t).alias(n) for n, t in totals.items()))
