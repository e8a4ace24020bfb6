"""Inputs, for batch and streaming alike: pass `spark.read` or `spark.readStream`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.once import once
from logloom.functions.patterns import glob_regex

# Default locations and units.
CONTAINER_LOGS = "/var/log/containers/*.log"
JOURNAL_UNITS = ("containerd.service", "kubelet.service", "node-agent.service")

JOURNAL_SCHEMA = (
    "MESSAGE string, _EXE string, _CMDLINE string, _PID string, _MACHINE_ID string, "
    "_SYSTEMD_UNIT string, _SYSTEMD_SLICE string, __REALTIME_TIMESTAMP string"
)
CLUSTER_SCHEMA = (
    "seq bigint, ts timestamp, op string, name string, deletion_ts timestamp, shoot_json string"
)
COLLECTOR_SCHEMA = (
    "seq bigint, op string, namespace string, name string, labels map<string,string>, "
    "deletion_ts timestamp"
)
NAMESPACE_SCHEMA = "name string, labels map<string,string>"
KUBE_EVENT_SCHEMA = (
    "namespace string, name string, creation_ts timestamp, observed_ts timestamp, "
    "involved_kind string, involved_name string, reason string, message string, type string, "
    "source_component string, source_host string, first_ts timestamp, last_ts timestamp, "
    "event_time timestamp, count int"
)
SAMPLE_SCHEMA = "ts timestamp, name string, labels map<string,string>, value double"


def spread_if_narrow(df: DataFrame, key: str) -> DataFrame:
    """Spread an input that is read by fewer tasks than there are cores, such as one small
    file; any other stays where it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


#: Rows of costly work for each task.
ROWS_PER_TASK = 200_000


def tasks_for(spark: SparkSession, rows: int, rows_per_task: int | None = None) -> int:
    """Tasks for costly work on so many rows: one a core at least."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // (rows_per_task or ROWS_PER_TASK)))


def spread_for_work(df: DataFrame, key: str, rows_per_task: int | None = None) -> DataFrame:
    """Spread stored rows before costly work, if they are read by too few tasks for their number.

    Compact files hold millions of rows in what one task reads. They are counted first, which for
    Parquet reads file footers only.
    """
    tasks = tasks_for(df.sparkSession, df.count(), rows_per_task)
    return df.repartition(tasks, key) if df.rdd.getNumPartitions() < tasks else df


def tag_of(path: Column) -> Column:
    """File path to tag: `kubernetes` and the path with dots for slashes."""
    bare = F.regexp_replace(path, "^file:/+", "/")
    return F.concat(F.lit("kubernetes"), F.translate(bare, "/", "."))


def container_lines(reader, path: str = CONTAINER_LOGS, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Lines of container log files (`value`) with their `tag` and the file's time `file_ts`;
    excluded files are not kept."""
    lines = reader.format("text").load(path).select(
        "value", F.col("_metadata.file_path").alias("p"),
        F.col("_metadata.file_modification_time").alias("file_ts"))
    for glob in exclude:
        lines = lines.filter(~F.regexp_replace("p", "^file:/+", "/").rlike(glob_regex(glob)))
    return lines.withColumn("tag", tag_of(F.col("p"))).drop("p")


def json_lines(reader, path: str, schema: str) -> DataFrame:
    """JSON lines by `schema`, and `corrupt`: the raw text of a line that does not fit, else NULL."""
    lines = reader.format("text").load(path).filter(F.trim("value") != "")
    decoded = F.from_json("value", f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    # a document that is no object leaves no corrupt text either
    whole = F.startswith(F.ltrim("value"), F.lit("{")) & F.col("_row._corrupt").isNull()
    rows = once(lines, _row=decoded).withColumn("corrupt", F.when(~whole, F.col("value")))
    return rows.select("_row.*", "corrupt").drop("_corrupt")


def parsed(rows: DataFrame) -> DataFrame:
    """The lines of `json_lines` that were read."""
    return rows.filter("corrupt IS NULL").drop("corrupt")


def corrupt(rows: DataFrame, source: str) -> DataFrame:
    """The others, as `source` and raw `line`."""
    return rows.filter("corrupt IS NOT NULL").select(F.lit(source).alias("source"), F.col("corrupt").alias("line"))


def journal(reader, path: str, units: tuple[str, ...] = JOURNAL_UNITS) -> DataFrame:
    """Journal export (JSON lines) of the given units, with `ts`, `nanos` and `tag`.

    Lines that do not parse are in `corrupt(json_lines(reader, path, JOURNAL_SCHEMA), ...)`.
    """
    entries = parsed(json_lines(reader, path, JOURNAL_SCHEMA))
    entries = entries.filter(F.col("_SYSTEMD_UNIT").isin(*units))
    at = F.col("__REALTIME_TIMESTAMP").try_cast("bigint")
    return entries.withColumns(
        {
            "ts": F.timestamp_micros(at),
            "nanos": F.pmod(at, F.lit(1_000_000)) * 1000,
            "tag": F.concat(F.lit("systemd."), F.col("_SYSTEMD_UNIT")),
        }
    ).drop("__REALTIME_TIMESTAMP")


def cluster_changes(reader, path: str) -> DataFrame:
    return reader.schema(CLUSTER_SCHEMA).parquet(path)


def collector_changes(reader, path: str) -> DataFrame:
    return reader.schema(COLLECTOR_SCHEMA).parquet(path)


def namespaces(reader, path: str) -> DataFrame:
    return reader.schema(NAMESPACE_SCHEMA).parquet(path)


def kube_events(reader, path: str) -> DataFrame:
    """Kubernetes events of one origin, one JSON object per line; `json_lines` has those that fail."""
    return parsed(json_lines(reader, path, KUBE_EVENT_SCHEMA))


def metric_samples(reader, path: str) -> DataFrame:
    return reader.schema(SAMPLE_SCHEMA).parquet(path)
