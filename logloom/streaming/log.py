"""A table kept as a base and one delta for each micro-batch.

A batch writes only its own rows, to a folder that a repeat of the batch replaces. `merge` folds the
deltas into a new base, at any time and beside running readers and writers: a folder counts when its
write is committed, a base replaces the deltas up to its number, and what the base before it needs
is kept for readers that opened that one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def file_system(spark: SparkSession, pattern: str) -> tuple:
    """Hadoop path and its file system, whatever that is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def committed(spark: SparkSession, path: str, name: str) -> dict[int, str]:
    """Folders `name=N` below `path` whose write was committed."""
    pattern, store = file_system(spark, f"{path}/{name}=*/_SUCCESS")
    done = (s.getPath().getParent() for s in store.globStatus(pattern) or ())
    return {int(p.getName().partition("=")[2]): p.toString() for p in done}


class BatchLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def append(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/delta={batch_id}")

    def folders(self, before: int | None = None) -> list[str]:
        """The newest base and the deltas after it, of batches below `before` if that is given."""
        def known(name):
            found = committed(self.spark, self.path, name)
            return {n: p for n, p in found.items() if before is None or n < before}

        bases, deltas = known("base"), known("delta")
        base = max(bases, default=-1)
        after = [p for n, p in sorted(deltas.items()) if n > base]
        return [bases[base], *after] if bases else after

    def read(self, before: int | None = None) -> DataFrame | None:
        """The table as of the batches below `before`; None if there is none."""
        found = self.folders(before)
        return self.spark.read.parquet(*found) if found else None

    def merge(self, combine: Callable[[DataFrame], DataFrame] = DataFrame.distinct) -> None:
        """A new base of all that is committed, and no folders that only bases before the last need."""
        bases, deltas = (committed(self.spark, self.path, n) for n in ("base", "delta"))
        newest, last = max(deltas, default=-1), max(bases, default=-1)
        if newest > last:
            combine(self.read()).write.mode("overwrite").parquet(f"{self.path}/base={newest}")
        for found in ([p for n, p in bases.items() if n < last], [p for n, p in deltas.items() if n <= last]):
            for old in found:
                path, store = file_system(self.spark, old)
                store.delete(path, True)
