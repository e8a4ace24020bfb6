"""Stored logs: the searchable columns of kept records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.once import once
from logloom.functions.severity import severity_of
from logloom.operators.otel import body_of, k8s_metadata
from logloom.operators.routing import with_host
from logloom.options import RouteOptions


def stored_logs(records: DataFrame, options: RouteOptions) -> DataFrame:
    """`record_id, ts, namespace, container, body, severity_text, origin` of kept records.

    A time filter on the result reaches the file scan; unused columns are not computed.
    """
    kept = with_host(records, options).filter(~F.col("lost_metadata"))
    fields = F.col("fields")
    found = once(kept, k8s=k8s_metadata(fields))
    return found.select(
        "record_id", "ts", F.col("k8s.namespace_name").alias("namespace"),
        F.col("k8s.container_name").alias("container"), body_of(fields).alias("body"),
        severity_of(fields)["text"].alias("severity_text"),
        F.when(F.col("dynamic"), "shoot").otherwise("seed").alias("origin"),
    )
