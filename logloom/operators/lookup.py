"""Joins against a smaller table whose size is measured, never assumed."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.session import settle

MAX_ROWS = 1_000_000
MAX_BYTES = 64 << 20
ROWS_PER_TASK = 2_000_000
SPREAD_OF_NULLS = 10_000


def fits_broadcast(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """Row count and serialised size of `df`, both within bounds."""
    size = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("b"),
    ).first()
    return size.n <= max_rows and (size.b or 0) <= max_bytes


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    keys: list[str],
    how: str = "left",
    condition: Column | None = None,
    spread: str | None = None,
    max_rows: int = MAX_ROWS,
    max_bytes: int = MAX_BYTES,
    settled: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join `facts` (any size, skewed keys) with `table` on `keys`, which are named alike.

    The table is computed once (unless it is `settled`: stored, or cheap to read again) and
    measured. Within bounds it is broadcast, so the facts do
    not move. Beyond them both sides shuffle: keys with more than `rows_per_task` facts, found by
    counting, get as many salts by `spread` as that makes tasks, and their table rows are repeated
    once per salt.
    """
    table = table if settled else settle(table)
    names = {k: f"_right_{k}" for k in keys}
    right = table.withColumnsRenamed(names)
    if fits_broadcast(table, max_rows, max_bytes):
        right = F.broadcast(right)
        on = F.lit(True)
    else:
        hot = settle(facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(
            F.col("_n") > rows_per_task))
        salts = {"_salts": F.ceil(F.col("_n") / rows_per_task).cast("int")}
        hot = F.broadcast(hot.withColumns(salts).drop("_n").withColumnsRenamed(
            {k: f"_hot_{k}" for k in keys}))  # at most one row for `rows_per_task` facts
        salt_of = F.xxhash64(spread) if spread else F.xxhash64(*facts.columns)
        n = F.coalesce("_salts", F.lit(1))
        # a fact with a NULL key meets nothing: such facts go anywhere but to one task
        free = F.when(reduce(or_, (F.col(k).isNull() for k in keys)), F.lit(SPREAD_OF_NULLS))
        names_hot = [f"_hot_{k}" for k in keys]
        facts = facts.join(hot, [F.col(k) == F.col(f"_hot_{k}") for k in keys], "left").withColumn(
            "_salt", F.pmod(salt_of, F.coalesce(free, n)).cast("int")).drop("_salts", *names_hot)
        right = right.join(hot, [F.col(names[k]) == F.col(f"_hot_{k}") for k in keys], "left")
        right = right.withColumn("_right_salt", F.explode(F.sequence(F.lit(0), n - 1))).drop(
            "_salts", *names_hot)
        on = F.col("_salt") == F.col("_right_salt")
    for key in keys:
        on = (F.col(key) == F.col(names[key])) & on
    if condition is not None:
        on = on & condition
    return facts.join(right, on, how).drop(*names.values(), "_salt", "_right_salt")
