"""What the operators share: intermediate tables, words, files."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.session import checkpoint_dir

SPACE = " \t\n\x0b\f\r"
SPACE_RUN = "[ \\t\\n\\x0B\\f\\r]+"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the session's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it back: computed once, lineage cut."""
    folder = scratch(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def words(text: Column) -> Column:
    """The runs of other characters between ASCII white space; NULL has none."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))


def word_count(text: Column) -> Column:
    """Number of `words(text)`."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, SPACE_RUN))).cast("long")


def packed(docs: DataFrame) -> DataFrame:
    """`docs` as one column `_row` with the row key `_own_id`, `_own_text` beside it.

    Whatever other columns are called, they cannot clash with an operator's own.
    """
    return docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_own_id"),
                       F.xxhash64("text").alias("_own_text"))


def same_row() -> Column:
    """A `packed` row meets its key in a table with `_id` and `_text`."""
    return F.col("_own_id").eqNullSafe(F.col("_id")) & (F.col("_own_text") == F.col("_text"))


def minus(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows of `docs` whose id and text are not among the `_id`, `_text` of `rejected`."""
    gone = rejected.select("_id", "_text").distinct()
    return packed(docs).join(gone, same_row(), "left_anti").select("_row.*")


def open_store(uri: str):
    """pyarrow file system and path of a folder that all executors share, whatever its scheme."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), os.path.abspath(uri)
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers, once per application, wherever they run."""
    import tempfile
    import zipfile
    from pathlib import Path

    context = spark.sparkContext
    if getattr(context, "_logloom_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    name = os.path.join(tempfile.mkdtemp(prefix="logloom-"), "logloom-package.zip")
    with zipfile.ZipFile(name, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(name)
    context._logloom_shipped = True
