"""Counters and gauges as aggregates over the ledger and the delivery tables.

All have the form (metric, label, reason, value); partial aggregation keeps shuffles at one
row per label and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.operators.metadata import NO_METADATA

# Metric names, the metadata error type and drop reasons.
INCOMING = "incoming_logs_total"
WITHOUT_METADATA = "logs_without_metadata_total"
ERRORS = "errors_total"
DROPPED = "dropped_logs_total"
OUTPUT = "output_client_logs_total"
CLIENTS = "clients_total"
MISSING_METADATA_TYPE = "Kubernetes"
INVALID_KEY = "InvalidRecordKey"
QUEUE_FULL = "queue_full"
#: Not a fixed value: lines of a source that are no record.
MALFORMED_LINE = "MalformedLine"


def _increment(metric: str, label: Column, reason: Column | None = None) -> Column:
    return F.struct(
        F.lit(metric).alias("metric"),
        label.alias("label"),
        (F.lit("") if reason is None else reason).alias("reason"),
    )


def ledger_counters(ledger_rows: DataFrame) -> DataFrame:
    """Every record counter in one pass over the ledger.

    Records that add to the same counters are counted first, so that few rows are spread out.
    """
    alike = ledger_rows.groupBy("host", "disposition", "errors", "destinations").agg(
        F.count(F.lit(1)).alias("_n"))
    lost = F.col("disposition") == NO_METADATA
    single = F.array_compact(
        F.array(
            F.when(~lost, _increment(INCOMING, F.col("host"))),
            F.when(lost, _increment(WITHOUT_METADATA, F.lit(MISSING_METADATA_TYPE))),
            F.when(
                F.col("disposition") == "dropped_no_client",
                _increment(DROPPED, F.col("host"), F.lit("no_client")),
            ),
        )
    )
    errors = F.transform("errors", lambda e: _increment(ERRORS, e))
    sent = F.transform(
        "destinations",
        lambda d: F.when(
            d["client"] == "noop", _increment(DROPPED, d["endpoint"], F.lit("noop"))
        ).otherwise(_increment(OUTPUT, d["endpoint"])),
    )
    return (
        alike.select("_n", F.inline(F.concat(single, errors, sent)))
        .groupBy("metric", "label", "reason")
        .agg(F.sum("_n").alias("value"))
    )


def counter(ledger_rows: DataFrame, metric: str) -> DataFrame:
    return ledger_counters(ledger_rows).filter(F.col("metric") == metric)


def invalid_key_errors(records: DataFrame) -> DataFrame:
    """Record keys that were not strings, as an error counter."""
    return records.agg(F.coalesce(F.sum("invalid_keys"), F.lit(0)).alias("value")).select(
        F.lit(ERRORS).alias("metric"), F.lit(INVALID_KEY).alias("label"), F.lit("").alias("reason"),
        "value",
    )


def malformed_lines(corrupt: DataFrame) -> DataFrame:
    """Lines that did not parse (`source`, `line`), as an error counter."""
    return corrupt.groupBy(F.concat(F.lit(f"{MALFORMED_LINE}:"), "source").alias("label")).agg(
        F.count(F.lit(1)).alias("value")).select(
        F.lit(ERRORS).alias("metric"), "label", F.lit("").alias("reason"), "value")


def queue_full(rejected: DataFrame) -> DataFrame:
    """Records that a full queue turned away (`endpoint`, `rejected`), as a drop counter."""
    return rejected.filter("rejected > 0").select(
        F.lit(DROPPED).alias("metric"), F.col("endpoint").alias("label"), F.lit(QUEUE_FULL).alias("reason"),
        F.col("rejected").cast("bigint").alias("value"))


def summed(*parts: DataFrame) -> DataFrame:
    """One frame of counters from several, of sources or of batches."""
    every = parts[0]
    for more in parts[1:]:
        every = every.unionByName(more)
    return every.groupBy("metric", "label", "reason").agg(F.sum("value").alias("value")).filter("value > 0")


def clients(routes: DataFrame, controller_seed: bool = True) -> DataFrame:
    """Live destinations by type: routes, plus the seed client of plugin and controller."""
    shoot = routes.agg(F.count(F.lit(1)).alias("value")).select(
        F.lit(CLIENTS).alias("metric"), F.lit("SHOOT").alias("label"), "value"
    )
    seeds = 2 if controller_seed else 1
    seed = routes.sparkSession.range(1).select(
        F.lit(CLIENTS).alias("metric"), F.lit("SEED").alias("label"),
        F.lit(seeds).cast("bigint").alias("value"),
    )
    return shoot.unionByName(seed)


def accounting(ledger_rows: DataFrame) -> DataFrame:
    """Volume check in one row: incoming, noop-dropped, errors, and whether they reconcile."""
    noop = F.exists("destinations", lambda d: d["client"] == "noop").cast("bigint")
    sums = ledger_rows.agg(
        F.count_if(F.col("disposition") != NO_METADATA).alias("incoming"),
        F.coalesce(F.sum(noop), F.lit(0)).alias("noop_dropped"),
        F.coalesce(F.sum(F.size("errors").cast("bigint")), F.lit(0)).alias("errors"),
    )
    return sums.withColumn("clean", F.expr("incoming = noop_dropped and errors = 0"))
