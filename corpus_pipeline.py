"""From raw documents to token shards: quality, near copies, benchmark leaks, mix, token ids.

Each stage works on all that the one before kept; `run` writes each result as Parquet to the shared
folder and reads it again. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logloom.llm import decontaminate, mixing, outliers, repair, simhash
from logloom.llm.common import stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outlier of their language and source."""
    return outliers.keep_good(docs)


def near_copies_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def benchmark_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def sources_mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, a row for each epoch."""
    return mixing.mixed_documents(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document's ids as read back from the shards."""
    return repair.round_trip(docs)


STAGES = [
    ("quality rules", good_quality),
    ("SimHash near-dedup", near_copies_removed),
    ("benchmark decontamination", benchmark_removed),
    ("mixing sources", sources_mixed),
    ("token-ID output", token_shards),
]

#: Fingerprints, draws and token ids cannot be stated in SQL; the tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
