"""Where delivered records go."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.values import html_safe
from logloom.operators.routing import CLIENT_TYPES

# Fields that name a stored log stream.
STREAM_FIELDS = (
    "k8s.event.reason", "k8s.node.name", "k8s.namespace.name", "k8s.object.name", "k8s.pods.name",
    "k8s.container.name", "severity", "k8s.object.kind", "origin",
)


class Sink(Protocol):
    """A destination for one batch of log records."""

    def write(self, batch: DataFrame, batch_id: int) -> None: ...


def stdout_lines(df: DataFrame, *keep: str) -> DataFrame:
    """One JSON line (`value`) per record: timestamp and record."""
    moment = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    line = F.concat(
        F.lit('{"record":'), html_safe(F.to_json("fields")), F.lit(',"timestamp":"'), moment,
        F.lit('"}'),
    )
    return df.select(*keep, line.alias("value"))


class NoopSink:
    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.format("noop").mode("overwrite").save()


class StdoutSink:
    """JSON lines, in a folder per batch so that a repeated batch replaces itself."""

    def __init__(self, path: str):
        self.path = path

    def write(self, batch: DataFrame, batch_id: int) -> None:
        lines = stdout_lines(batch)
        lines.write.mode("overwrite").text(f"{self.path}/batch_id={batch_id}")


class OtelSink:
    """Log records as parquet by endpoint, or to an exporter called once per partition.

    A repeated batch replaces its own folder, so delivery twice leaves one copy.
    """

    def __init__(self, path: str, export: Callable[[Iterator], None] | None = None):
        self.path, self.export = path, export

    def write(self, batch: DataFrame, batch_id: int) -> None:
        if self.export is not None:
            batch.foreachPartition(self.export)
            return
        # one writer per endpoint, more for a large one: few files, no skewed task
        gathered = batch.hint("rebalance", "endpoint")
        gathered.write.mode("overwrite").partitionBy("endpoint").parquet(
            f"{self.path}/batch_id={batch_id}"
        )


def sink_for(client: str, path: str, export: Callable[[Iterator], None] | None = None) -> Sink:
    """Sink of a client type; names that are no client type discard."""
    kind = CLIENT_TYPES.get(client.upper(), "noop")
    if kind == "stdout":
        return StdoutSink(path)
    return NoopSink() if kind == "noop" else OtelSink(path, export)


def sink_for_target(target: str, clients: dict[str, str], path: str) -> Sink:
    """Sink configured for `SEED` or `SHOOT`; any other target is an error."""
    if target.upper() not in ("SEED", "SHOOT"):
        raise ValueError(f"unknown target: {target!r}")
    return sink_for(clients[target.upper()], f"{path}/{target.lower()}")


def with_stream_id(df: DataFrame, *fields: str) -> DataFrame:
    """Add `stream_id`, the digest of the stream fields."""
    return df.withColumn("stream_id", F.sha2(F.to_json(F.struct(*fields)), 256))


def write_streams(df: DataFrame, path: str) -> None:
    """Store logs by day and namespace; rows are clustered by stream inside the files."""
    dated = df.withColumn("date", F.to_date("ts")).hint("rebalance", "date", "namespace")
    clustered = dated.sortWithinPartitions("date", "namespace", "stream_id", "ts")
    clustered.write.mode("append").partitionBy("date", "namespace").parquet(path)
