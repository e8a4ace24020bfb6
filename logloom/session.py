"""Session settings the engine relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Timestamps are UTC everywhere."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that `spark.checkpoint.dir` names; in local mode a scratch one if it is unset."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="logloom-")
        spark.conf.set("spark.checkpoint.dir", shared)
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared)
    return shared


def settle(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage, reliably (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
