"""Readers and sinks: what is written to the session's shared folder is read back."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.once import once
from logloom.operators import buffer, clusters, collectors, counters, otel, routing, search, select
from logloom.operators.stored import stored_logs
from logloom.options import RouteOptions
from logloom.plans import views
from logloom.plans.oracle import CHANGES, KUBE_EVENTS, LEDGER, LOGS, SAMPLES, sql
from logloom.plans.registry import query
from logloom.plans.routing_queries import (
    COLLECTORS,
    COUNTERS_SQL,
    ID_PATTERN,
    QUEUE,
    STORED,
    invalid_key_errors,
    queue_depths,
)
from logloom.session import checkpoint_dir
from logloom.sources import readers, records, sinks

OPTIONS = RouteOptions()


def _workspace(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/io-{uuid.uuid4().hex}"


def _kept(df: DataFrame, path: str) -> DataFrame:
    """`df` written once and read back, for results that are used more than one time."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@query(sql("""
SELECT event_type AS kind, CASE WHEN event_id % 40 = 0 THEN 'panic' ELSE strftime(ts, '%Y') END
  AS head, count(*) AS lines FROM events WHERE event_type <> 'error' GROUP BY ALL"""))
def container_files(spark: SparkSession, folder: str) -> DataFrame:
    """Log files by event type, read with their tags; one type is excluded."""
    path = _workspace(spark)
    events = views.table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("record_id"), "event_type")
    lines = views.container_text(spark, folder).join(events, "record_id")
    lines.select("value", F.col("event_type").alias("kind")).write.partitionBy("kind").text(path)
    found = readers.container_lines(spark.read, f"{path}/*", exclude=("*/kind=error/*",))
    kind = F.regexp_extract("tag", r"^kubernetes\..*\.kind=([a-z]+)\.", 1)
    head = F.when(F.col("value").startswith("panic"), "panic").otherwise(F.substring("value", 1, 4))
    return found.groupBy(kind.alias("kind"), head.alias("head")).agg(
        F.count(F.lit(1)).alias("lines"))


@query(sql("""
SELECT make_timestamp((1704067200 + conv_id * 60 + turn) * 1000000) AS ts, text AS message,
  CASE role WHEN 'user' THEN 'systemd.kubelet.service' ELSE 'systemd.containerd.service' END AS tag
FROM conversations WHERE role IN ('user', 'assistant')"""))
def journal_files(spark: SparkSession, folder: str) -> DataFrame:
    """Journal entries of two units."""
    path = _workspace(spark)
    entries = views.journal(spark, folder)
    at = F.unix_micros(F.col("ts").cast("timestamp")).cast("string")
    entries.withColumn("__REALTIME_TIMESTAMP", at).drop("record_id", "ts", "nanos", "tag").write.json(path)
    found = readers.journal(spark.read, path, ("kubelet.service", "containerd.service"))
    return found.select(F.col("ts").cast("timestamp_ntz").alias("ts"),
                        F.col("MESSAGE").alias("message"), "tag")


@query(sql("SELECT host, endpoint, to_shoot, to_seed FROM routes", LOGS, CHANGES))
def cluster_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Routes from stored cluster changes."""
    path = _workspace(spark)
    changes = views.cluster_changes(spark, folder)
    times = {c: F.col(c).cast("timestamp") for c in ("ts", "deletion_ts")}
    changes.withColumns(times).write.parquet(path)
    found = readers.cluster_changes(spark.read, path)
    return clusters.current_routes(found, OPTIONS).select("host", "endpoint", "to_shoot", "to_seed")


@query(sql("""
SELECT seq, namespace, name FROM collector SEMI JOIN allowed USING (namespace)
WHERE fits AND NOT gone""", COLLECTORS))
def collector_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Admission over stored collector changes and namespaces."""
    path = _workspace(spark)
    changes = views.collector_changes(spark, folder)
    changes.withColumn("deletion_ts", F.col("deletion_ts").cast("timestamp")).write.parquet(f"{path}/c")
    views.namespaces(spark, folder).write.parquet(f"{path}/n")
    return collectors.admitted_collectors(
        readers.collector_changes(spark.read, f"{path}/c"),
        readers.namespaces(spark.read, f"{path}/n"), "app=logs", "role=shoot", OPTIONS,
    ).select("seq", "namespace", "name")


@query(sql("""
SELECT namespace, 'event-' || o_orderkey AS name, o_orderdate AS first_ts,
  CAST(o_orderkey % 4 AS INTEGER) AS count
FROM (SELECT *, CASE o_orderkey % 3 WHEN 0 THEN 'kube-system' WHEN 1 THEN 'default'
        ELSE 'other' END AS namespace FROM orders)"""))
def kube_event_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Kubernetes events stored as JSON lines."""
    path = _workspace(spark)
    views.kube_events(spark, folder).write.json(path)
    found = readers.kube_events(spark.read, path)
    return found.select("namespace", "name", F.col("first_ts").cast("timestamp_ntz").alias("first_ts"),
                        "count")


MALFORMED = """
SELECT 'errors_total' AS metric, 'MalformedLine:journal' AS label, '' AS reason, count(*) AS value
FROM conversations WHERE conv_id % 5 = 2
UNION ALL
SELECT 'errors_total', 'MalformedLine:kubernetes', '', count(*) FROM orders WHERE o_orderkey % 7 = 3"""


def cut_lines(rows: DataFrame, lost: Column, path: str) -> None:
    """Store rows as JSON lines; of those that are `lost` the end is missing."""
    line = F.to_json(F.struct(*(c for c in rows.columns if c != "lost")))
    rows = once(rows, line=line, lost=lost)
    length = F.length("line")
    short = F.substring("line", F.lit(1), length - 1 - length % 9)
    rows.select(F.when(F.col("lost"), short).otherwise(F.col("line")).alias("value")).write.text(path)


def feeds_with_cut_lines(spark: SparkSession, folder: str, path: str) -> dict[str, DataFrame]:
    """Lines of a journal and of Kubernetes events, some cut off, by source."""
    cut_lines(views.journal(spark, folder).drop("record_id", "ts", "nanos", "tag"),
              F.col("_PID").cast("bigint") % 5 == 2, f"{path}/journal")
    number = F.regexp_extract("name", "([0-9]+)$", 1).cast("bigint")
    cut_lines(views.kube_events(spark, folder), number % 7 == 3, f"{path}/kubernetes")
    return {"journal": readers.json_lines(spark.read, f"{path}/journal", readers.JOURNAL_SCHEMA),
            "kubernetes": readers.json_lines(spark.read, f"{path}/kubernetes", readers.KUBE_EVENT_SCHEMA)}


@query(sql(MALFORMED))
def malformed_line_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that do not parse, counted by source as errors."""
    feeds = feeds_with_cut_lines(spark, folder, _workspace(spark))
    return counters.summed(*(counters.malformed_lines(readers.corrupt(rows, name))
                             for name, rows in feeds.items()))


@query(sql("""
SELECT namespace, 'event-' || o_orderkey AS name, CAST(o_orderkey % 4 AS INTEGER) AS count
FROM (SELECT *, CASE o_orderkey % 3 WHEN 0 THEN 'kube-system' WHEN 1 THEN 'default'
        ELSE 'other' END AS namespace FROM orders) WHERE o_orderkey % 7 <> 3"""))
def events_beside_cut_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Kubernetes events of a feed in which some lines are cut off: the others, and no row of NULLs."""
    path = _workspace(spark)
    feeds_with_cut_lines(spark, folder, path)
    return readers.kube_events(spark.read, f"{path}/kubernetes").select("namespace", "name", "count")


@query(sql(f"{COUNTERS_SQL} UNION ALL {MALFORMED} UNION ALL " + """
SELECT 'errors_total', 'InvalidRecordKey', '', count(*) FROM part WHERE p_size % 7 = 0 HAVING count(*) > 0
UNION ALL SELECT 'dropped_logs_total', endpoint, 'queue_full', count(*) FROM depths
WHERE change > 0 AND depth > 20 GROUP BY endpoint""", LOGS, CHANGES, LEDGER, QUEUE))
def all_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Every error and drop reason that a table here has, and all other record counters, in one frame."""
    routes = clusters.current_routes(views.cluster_changes(spark, folder), OPTIONS)
    ledger = routing.ledger(views.logs(spark, folder), routes, replace(OPTIONS, seed_type="noop"), whole=False)
    feeds = feeds_with_cut_lines(spark, folder, _workspace(spark))
    return counters.summed(
        counters.ledger_counters(ledger), invalid_key_errors(spark, folder),
        counters.queue_full(buffer.rejected(queue_depths(spark, folder), 20)),
        *(counters.malformed_lines(readers.corrupt(rows, name)) for name, rows in feeds.items()))


@query(sql("SELECT series, ts, value FROM samples", SAMPLES))
def metric_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Metric samples with labels."""
    path = _workspace(spark)
    samples = views.metric_samples(spark, folder)
    labels = F.create_map(F.lit("series"), F.col("series"))
    samples.select(F.col("ts").cast("timestamp").alias("ts"), F.lit("logs_total").alias("name"),
                   labels.alias("labels"), "value").write.parquet(path)
    found = readers.metric_samples(spark.read, path)
    return found.select(F.col("labels")["series"].alias("series"),
                        F.col("ts").cast("timestamp_ntz").alias("ts"), "value")


@query(sql("""
SELECT 'otlp' AS sink, endpoint, count(*) AS records FROM sent WHERE target = 'SHOOT'
GROUP BY endpoint
UNION ALL SELECT 'stdout', '', count(*) FROM sent WHERE target = 'SEED'""", LOGS, CHANGES, LEDGER))
def delivered_by_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Each target through the sink of its client type, every batch delivered twice."""
    path = _workspace(spark)
    clients = {"SEED": "stdout", "SHOOT": "otlp_grpc"}
    routes = clusters.current_routes(views.cluster_changes(spark, folder), OPTIONS)
    decided = routing.fan_out(routing.ledger(views.logs(spark, folder), routes, OPTIONS))
    sent = _kept(decided, f"{path}/sent")
    for target in clients:
        rows = sent.filter(F.col("target") == target)
        batch = rows if target == "SEED" else _kept(otel.to_otel(rows, OPTIONS), f"{path}/built")
        for _ in range(2):
            sinks.sink_for_target(target, clients, path).write(batch, 0)
    stored = spark.read.parquet(f"{path}/shoot").groupBy("endpoint").agg(
        F.count(F.lit(1)).alias("records"))
    lines = spark.read.text(f"{path}/seed").agg(F.count(F.lit(1)).alias("records"))
    return stored.select(F.lit("otlp").alias("sink"), "endpoint", "records").unionByName(
        lines.select(F.lit("stdout").alias("sink"), F.lit("").alias("endpoint"), "records"))


@query(sql(r"""
SELECT endpoint, count(*) AS records, min(record_id) AS first_id FROM sent WHERE target = 'SHOOT'
GROUP BY endpoint""", LOGS, CHANGES, LEDGER))
def committed_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records of the shoots through a data source with commits; every batch is delivered twice."""
    path = _workspace(spark)
    routes = clusters.current_routes(views.cluster_changes(spark, folder), OPTIONS)
    sent = routing.fan_out(routing.ledger(views.logs(spark, folder), routes, OPTIONS)).filter(
        "target = 'SHOOT'").select("endpoint", "record_id")
    for batch_id in (0, 0, 1, 1):
        half = F.pmod(F.col("record_id").cast("bigint"), F.lit(2)) == batch_id
        records.CommittedSink(path).write(sent.filter(half), batch_id)
    found = spark.read.format(records.NAME).load(path)
    return found.groupBy("endpoint").agg(
        F.count(F.lit(1)).alias("records"),
        F.min(F.get_json_object("record", "$.record_id")).alias("first_id"))


@query(sql(r"""
SELECT record_id, body FROM stored WHERE regexp_matches(body, 'value 1($|\W)') AND namespace IS NOT NULL
  AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'""", LOGS, STORED))
def phrase_in_indexed_files(spark: SparkSession, folder: str) -> DataFrame:
    """A phrase and a span of time, looked up in the index of stored files before any is opened."""
    path = _workspace(spark)
    logs = stored_logs(views.logs(spark, folder), OPTIONS).filter("namespace IS NOT NULL")
    sinks.write_streams(sinks.with_stream_id(logs, "namespace", "container", "severity_text"), path)
    search.write_index(spark, path, "body")
    found = search.search(spark, path, {"body": "value 1"}, since="2024-01-10", until="2024-01-20")
    return found.select("record_id", "body")


@query(sql(r"""
SELECT namespace, count(DISTINCT id) AS "unique", TRUE AS close FROM (
  SELECT namespace, nullif(regexp_extract(body, 'id: "([0-9]+)"', 1), '') AS id FROM stored)
GROUP BY namespace""", LOGS, STORED))
def unique_ids_from_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct ids of the month from hourly sketches, within 5 % of the exact number beside them."""
    path = _workspace(spark)
    logs = stored_logs(views.logs(spark, folder), OPTIONS)
    ids = select.extract(once(logs, body=F.col("body")), ID_PATTERN, "body", "id").withColumn(
        "namespace", F.coalesce("namespace", F.lit("")))
    ids = _kept(ids.select("ts", "namespace", "id"), f"{path}/ids")
    select.unique_sketches(ids, "id", "namespace").write.parquet(f"{path}/sketches")
    estimate = select.unique_in(spark.read.parquet(f"{path}/sketches"), "2024-01-01", "2024-02-01", "namespace")
    exact = select.count_unique(ids, "id", "namespace")
    both = exact.join(estimate.withColumnRenamed("unique", "estimate"), "namespace")
    close = F.abs(F.col("estimate") - F.col("unique")) <= F.greatest(0.05 * F.col("unique"), F.lit(1.0))
    return both.select(F.nullif("namespace", F.lit("")).alias("namespace"), "unique", close.alias("close"))


@query(sql("""
SELECT namespace, count(*) AS events, count(DISTINCT stream) AS streams FROM (
  SELECT *, (namespace, reason, object, origin, type) AS stream FROM shown)
GROUP BY namespace""", KUBE_EVENTS))
def stored_streams(spark: SparkSession, folder: str) -> DataFrame:
    """Kubernetes events stored by day and namespace under the nine stream fields."""
    from logloom.operators import kube_events

    path = _workspace(spark)
    feed = views.kube_events(spark, folder)
    events = kube_events.project(kube_events.fresh(kube_events.watched(
        kube_events.union_origins(feed, feed))))
    none = F.lit(None).cast("string")
    named = {
        "k8s.event.reason": F.col("reason"), "k8s.node.name": none,
        "k8s.namespace.name": F.col("namespace"),
        "k8s.object.name": F.substring_index("object", "/", -1), "k8s.pods.name": none,
        "k8s.container.name": none, "severity": F.col("type"),
        "k8s.object.kind": F.when(F.col("object").contains("/"), F.substring_index("object", "/", 1)),
    }
    logs = events.withColumns(named).withColumn("ts", F.date_trunc("year", "firstTimestamp"))
    fields = [f"`{f}`" for f in sinks.STREAM_FIELDS]
    sinks.write_streams(sinks.with_stream_id(logs, *fields), path)
    return spark.read.parquet(path).groupBy("namespace").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("stream_id").alias("streams"))
