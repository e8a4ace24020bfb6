"""Queue depth, from a table of moves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.operators.slices import HOUR, running


def occupancy(changes: DataFrame, width: int = HOUR) -> DataFrame:
    """Add `depth`: running sum of `change` (+1 enqueued, -1 dequeued) in order (ts, seq)."""
    return running(
        changes, ["endpoint"], ["ts", "seq"], {"depth": ("sum", F.col("change"))}, width
    )


def buffered(depths: DataFrame) -> DataFrame:
    """Queue depth now, per endpoint."""
    return depths.groupBy("endpoint").agg(
        F.max_by("depth", F.struct("ts", "seq")).alias("buffered")
    )


def depth_samples(depths: DataFrame, seconds: int = 30) -> DataFrame:
    """Last depth of every interval, per endpoint."""
    tick = F.window(F.col("ts"), f"{seconds} seconds")
    return depths.groupBy("endpoint", tick.alias("tick")).agg(
        F.max_by("depth", F.struct("ts", "seq")).alias("depth")
    ).select("endpoint", F.col("tick.start").alias("tick"), "depth")


def overflow(depths: DataFrame, max_queue: int, seconds: int = 30) -> DataFrame:
    """Intervals in which the queue of an endpoint reached its limit, with the peak."""
    tick = F.window(F.col("ts"), f"{seconds} seconds")
    return (
        depths.filter(F.col("depth") >= max_queue)
        .groupBy("endpoint", tick.alias("tick"))
        .agg(F.max("depth").alias("peak"), F.count(F.lit(1)).alias("samples"))
        .select("endpoint", F.col("tick.start").alias("tick"), "peak", "samples")
    )


def rejected(depths: DataFrame, max_queue: int) -> DataFrame:
    """Records that a queue of `max_queue` would have turned away, per endpoint: those whose entry
    took the depth above the limit."""
    return depths.groupBy("endpoint").agg(
        F.count_if((F.col("change") > 0) & (F.col("depth") > max_queue)).alias("rejected"))
