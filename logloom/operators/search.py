"""Stored logs with an index of their files, asked before any file is opened.

For every file the index holds Bloom filters of the words of each indexed text column and of the
stream ids, and the file's range of times and stream ids. It lies in a hidden folder beside the data.
A search reads only the files that can hold a result, and then filters exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.operators import bloom
from logloom.operators.lookup import lookup_join
from logloom.operators.select import at, field_has

STREAM = "stream_id"
_NO_WORD = r"[^\p{L}\p{M}\p{N}_]+"


def words(text: Column) -> Column:
    """Different words of a text, as `field_has` tells them apart."""
    return F.array_distinct(F.filter(F.split(text, _NO_WORD), lambda w: w != ""))


def write_index(spark: SparkSession, path: str, *columns: str) -> None:
    """Index the stored logs (`ts`, `stream_id`, text `columns`) below `path`, whole."""
    rows = spark.read.parquet(path).withColumn("_file", bloom.stored_file())
    files = bloom.numbered(rows.select(F.col("_file").alias("file")))
    known = lookup_join(rows.withColumnRenamed("_file", "file"), files, ["file"], settled=True)
    no = F.col("number").alias("file")
    items = known.select(F.lit(STREAM).alias("group"), no, F.col(STREAM).alias("item"))
    for c in columns:
        items = items.unionByName(known.select(F.lit(c).alias("group"), no, F.explode(words(F.col(c))).alias("item")))
    index = bloom.index_of(items).withColumnRenamed("file", "number")
    index = lookup_join(index, files.select("number", "file"), ["number"], settled=True).drop("number")
    index.write.mode("overwrite").partitionBy("group").parquet(f"{path}/_index/words")
    rows.groupBy(F.col("_file").alias("file")).agg(
        F.min("ts").alias("first"), F.max("ts").alias("last"), F.min(STREAM).alias("low"), F.max(STREAM).alias("high"),
    ).write.mode("overwrite").parquet(f"{path}/_index/ranges")


def files_for(
    spark: SparkSession, path: str, phrases: dict[str, str] | None = None, stream_id: str | None = None,
    since: str | None = None, until: str | None = None,
) -> list[str]:
    """Files that can hold rows of the search; their number is bounded by the index's."""
    found = spark.read.parquet(f"{path}/_index/ranges")
    if since is not None:
        found = found.filter(F.col("last") >= at(found, since, "last"))
    if until is not None:
        found = found.filter(F.col("first") < at(found, until, "first"))
    if stream_id is not None:
        found = found.filter((F.col("low") <= stream_id) & (F.col("high") >= stream_id))
    files = {r.file for r in found.select("file").collect()}
    index = spark.read.parquet(f"{path}/_index/words")
    for column, phrase in (phrases or {}).items():
        asked = spark.range(1).select(F.lit(column).alias("group"), F.explode(words(F.lit(phrase))).alias("item"))
        if not asked.isEmpty():
            files &= set(bloom.files_with_all(index.filter(F.col("group") == column), asked))
    if stream_id is not None:
        asked = spark.range(1).select(F.lit(STREAM).alias("group"), F.lit(stream_id).alias("item"))
        files &= set(bloom.files_with_all(index.filter(F.col("group") == STREAM), asked))
    return sorted(files)


def search(
    spark: SparkSession, path: str, phrases: dict[str, str] | None = None, stream_id: str | None = None,
    since: str | None = None, until: str | None = None,
) -> DataFrame:
    """Stored rows with all phrases, of one stream if given, at `since` or later and before `until`."""
    every = spark.read.parquet(path)
    files = files_for(spark, path, phrases, stream_id, since, until)
    if not files:
        return every.limit(0)
    rows = spark.read.schema(every.schema).option("basePath", path).parquet(*files)
    for column, phrase in (phrases or {}).items():
        rows = field_has(rows, column, phrase)
    if stream_id is not None:
        rows = rows.filter(F.col(STREAM) == stream_id)
    if since is not None:
        rows = rows.filter(F.col("ts") >= at(rows, since))
    if until is not None:
        rows = rows.filter(F.col("ts") < at(rows, until))
    return rows
