"""The same results from streaming runs, drained to the end."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.operators import clusters, kube_events, routing
from logloom.operators.parse import json_records
from logloom.options import RouteOptions
from logloom.plans import views
from logloom.plans.oracle import CHANGES, KUBE_EVENTS, LEDGER, LOGS, sql
from logloom.plans.registry import ORACLES, query
from logloom.session import checkpoint_dir
from logloom.streaming import jobs

OPTIONS = RouteOptions()


def _workspace(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"


def _drain(stream: DataFrame, deliver: jobs.Deliver, checkpoint: str, mode: str = "append") -> None:
    jobs.start(stream, deliver, checkpoint, mode=mode).awaitTermination()


@query(sql("SELECT record_id, host, disposition FROM ledger", LOGS, CHANGES, LEDGER))
def streamed_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Routes kept by one query, records decided and delivered by another."""
    work = _workspace(spark)
    events = views.stream_of(spark, folder, "events")
    changes = views.cluster_changes_of(events)
    _drain(changes, jobs.keep_routes(f"{work}/routes"), f"{work}/c1")
    deliver = jobs.route_records(
        work, OPTIONS, lambda: jobs.latest_routes(spark, f"{work}/routes", OPTIONS)
    )
    _drain(json_records(views.raw_logs_of(events)), deliver, f"{work}/c2")
    return spark.read.parquet(f"{work}/ledger").select("record_id", "host", "disposition")


@query(ORACLES["delivery_ledger_as_of"])
def streamed_ledger_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """The log of changes kept by one query; another gives each record the route of its own time."""
    work = _workspace(spark)
    events = views.stream_of(spark, folder, "events")
    _drain(views.cluster_changes_of(events), jobs.keep_routes(f"{work}/routes", OPTIONS, 2), f"{work}/c1")
    deliver = jobs.route_records(
        work, OPTIONS, lambda: jobs.known_history(spark, f"{work}/routes", OPTIONS), as_of=True)
    _drain(json_records(views.raw_logs_of(events)), deliver, f"{work}/c2")
    return spark.read.parquet(f"{work}/ledger").select("record_id", "host", "disposition")


@query(sql("""
SELECT make_timestamp(CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600000000) AS tick, host,
  count(*) AS records FROM hosted WHERE NOT failed GROUP BY ALL""", LOGS))
def streamed_interval_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Incoming records per hour and host, counted by micro-batch and added up."""
    work = _workspace(spark)
    records = json_records(views.raw_logs_of(views.stream_of(spark, folder, "events")))
    kept = routing.with_host(records, OPTIONS).filter(~F.col("lost_metadata"))
    _drain(kept, jobs.count_batches(f"{work}/counts", "host", every="1 hour"), f"{work}/c")
    counts = jobs.interval_counts(spark, f"{work}/counts", "host")
    return counts.withColumn("tick", F.col("tick").cast("timestamp_ntz"))


@query(sql("SELECT * FROM shown", KUBE_EVENTS))
def streamed_kubernetes_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events of both origins as one stream; those seen too late are dropped."""
    work = _workspace(spark)
    feed = views.kube_events_of(views.stream_of(spark, folder, "orders"))
    fresh = kube_events.fresh(kube_events.watched(kube_events.union_origins(feed, feed)))
    _drain(kube_events.project(fresh), jobs.write_batches(f"{work}/out"), f"{work}/c")
    shown = spark.read.parquet(f"{work}/out").drop("batch_id")
    times = ("eventTime", "firstTimestamp", "lastTimestamp")
    return shown.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


@query(sql("""
SELECT event_type, count(*) AS records, count(DISTINCT CASE WHEN event_id % 7 <> 0 THEN event_id END) AS ids
FROM (SELECT *, unnest(range(CASE WHEN event_id % 7 = 0 AND event_id % 3 = 0 THEN 2 ELSE 1 END)) FROM events)
GROUP BY event_type"""))
def streamed_without_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Every third record is sent twice and stored once, unless it is one of those without an id."""
    work = _workspace(spark)
    events = views.stream_of(spark, folder, "events")
    copies = F.when(F.col("event_id") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    own_id = F.when(F.col("event_id") % 7 != 0, F.col("event_id"))
    sent = events.select("ts", "event_type", own_id.alias("record_id"), F.explode(copies).alias("copy"))
    _drain(sent, jobs.deliver_once(f"{work}/out"), f"{work}/c")
    return spark.read.parquet(f"{work}/out").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("record_id").alias("ids")
    )


@query(sql("SELECT host, to_shoot, to_seed FROM routes", CHANGES))
def streamed_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Mute flags of every live cluster, held in keyed state."""
    work = _workspace(spark)
    jobs.use_state_store(spark)
    changes = views.cluster_changes_of(views.stream_of(spark, folder, "events"))
    flags = jobs.mute_flags(clusters.effective_changes(changes, OPTIONS), OPTIONS)
    _drain(flags, jobs.keep_flags(f"{work}/flags"), f"{work}/c", mode="update")
    return jobs.kept_flags(spark, f"{work}/flags")
