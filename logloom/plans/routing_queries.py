"""Queries over clusters, routing, delivery and stored logs."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.selectors import label_selector
from logloom.operators import (
    buffer,
    clusters,
    collectors,
    counters,
    kube_events,
    routing,
    select,
)
from logloom.operators.stored import stored_logs
from logloom.options import RouteOptions
from logloom.plans import views
from logloom.plans.oracle import CHANGES, KUBE_EVENTS, LEDGER, LOGS, sql
from logloom.plans.registry import query

OPTIONS = RouteOptions()
DAY_END = "2024-01-20 00:00:00"


def _routes(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.current_routes(views.cluster_changes(spark, folder), OPTIONS)


def _ledger(spark: SparkSession, folder: str, options: RouteOptions = OPTIONS) -> DataFrame:
    return routing.ledger(views.logs(spark, folder), _routes(spark, folder), options, whole=False)


@query(sql("""
SELECT seq, name, action, state, to_shoot, to_seed FROM (
  SELECT *, state NOT IN ('hibernating', 'hibernated') AS to_shoot,
    state IN ('creation', 'deletion', 'deleted', 'restore', 'migration') AS to_seed
  FROM classified)""", CHANGES))
def cluster_states(spark: SparkSession, folder: str) -> DataFrame:
    """Decoded changes: effect, lifecycle state and mute policy of each."""
    changes = clusters.classify_changes(views.cluster_changes(spark, folder), OPTIONS)
    to_shoot, to_seed = clusters.policy_flags(F.col("state"), OPTIONS)
    return changes.select(
        "seq", "name", "action", "state", to_shoot.alias("to_shoot"), to_seed.alias("to_seed")
    )


@query(sql("""
SELECT state, state NOT IN ('hibernated') AS to_shoot,
  state NOT IN ('ready', 'hibernating', 'hibernated', 'waking', 'deletion') AS to_seed,
  count(*) AS changes
FROM classified WHERE state IS NOT NULL GROUP BY ALL""", CHANGES))
def policy_overrides(spark: SparkSession, folder: str) -> DataFrame:
    """Changes per state under an overridden mute policy."""
    options = OPTIONS.with_policy(hibernating=(True, False), deletion=(True, False))
    changes = clusters.classify_changes(views.cluster_changes(spark, folder), options)
    to_shoot, to_seed = clusters.policy_flags(F.col("state"), options)
    return changes.filter("state is not null").groupBy(
        "state", to_shoot.alias("to_shoot"), to_seed.alias("to_seed")
    ).agg(F.count(F.lit(1)).alias("changes"))


@query(sql("SELECT host, state, to_shoot, to_seed, endpoint FROM routes", CHANGES))
def current_routes(spark: SparkSession, folder: str) -> DataFrame:
    return _routes(spark, folder)


@query(sql("SELECT host, valid_from, valid_to, state, to_shoot, to_seed FROM history", CHANGES))
def route_history(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.route_history(views.cluster_changes(spark, folder), OPTIONS).drop("endpoint")


@query(sql("SELECT record_id, host, disposition FROM ledger", LOGS, CHANGES, LEDGER))
def delivery_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Disposition of every record under the routes known now."""
    return _ledger(spark, folder).select("record_id", "host", "disposition")


@query(sql("""
SELECT record_id, l.host,
  CASE WHEN failed THEN 'dropped_no_metadata' WHEN NOT dynamic THEN 'routed'
    WHEN h.host IS NULL THEN 'dropped_no_client'
    WHEN NOT h.to_shoot AND NOT h.to_seed THEN 'muted' ELSE 'routed' END AS disposition
FROM hosted l LEFT JOIN history h ON l.host = h.host AND l.ts >= h.valid_from
  AND (h.valid_to IS NULL OR l.ts < h.valid_to)""", LOGS, CHANGES))
def delivery_ledger_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Disposition of every record under the route live at its own time."""
    history = clusters.route_history(views.cluster_changes(spark, folder), OPTIONS)
    decided = routing.ledger_as_of(views.logs(spark, folder), history, OPTIONS)
    return decided.select("record_id", "host", "disposition")


@query(sql("SELECT record_id, target, endpoint FROM sent", LOGS, CHANGES, LEDGER))
def fan_out(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record and destination."""
    return routing.fan_out(_ledger(spark, folder)).select("record_id", "target", "endpoint")


@query(sql("""
SELECT disposition, count(*) AS records FROM (
  SELECT CASE WHEN is_empty AND failed THEN 'dropped_empty' ELSE 'routed' END AS disposition
  FROM hosted) GROUP BY ALL""", LOGS))
def seed_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """No controller yet: dynamic hosts go to the seed; nothing is dropped for its metadata."""
    options = replace(OPTIONS, controller_present=False, drop_without_metadata=False)
    decided = routing.ledger(views.logs(spark, folder), None, options)
    return decided.groupBy("disposition").agg(F.count(F.lit(1)).alias("records"))


COUNTERS_SQL = """
SELECT 'incoming_logs_total' AS metric, host AS label, '' AS reason, count(*) AS value
FROM ledger WHERE NOT failed GROUP BY host
UNION ALL SELECT 'logs_without_metadata_total', 'Kubernetes', '', count(*) FROM ledger WHERE failed
UNION ALL SELECT 'errors_total', 'CanNotExtractMetadataFromTag', '', count(*) FROM ledger
  WHERE failed
UNION ALL SELECT 'dropped_logs_total', host, 'no_client', count(*) FROM ledger
  WHERE disposition = 'dropped_no_client' GROUP BY host
UNION ALL SELECT 'output_client_logs_total', endpoint, '', count(*) FROM sent
  WHERE target = 'SHOOT' GROUP BY endpoint
UNION ALL SELECT 'dropped_logs_total', endpoint, 'noop', count(*) FROM sent
  WHERE target = 'SEED' GROUP BY endpoint"""


@query(sql(COUNTERS_SQL, LOGS, CHANGES, LEDGER))
def record_counters(spark: SparkSession, folder: str) -> DataFrame:
    """All record counters, with a discarding seed."""
    return counters.ledger_counters(_ledger(spark, folder, replace(OPTIONS, seed_type="noop")))


@query(sql("""
SELECT 'clients_total' AS metric, 'SHOOT' AS label, count(*) AS value FROM routes
UNION ALL SELECT 'clients_total', 'SEED', 2""", CHANGES))
def live_clients(spark: SparkSession, folder: str) -> DataFrame:
    return counters.clients(_routes(spark, folder))


@query(sql("""
SELECT count(*) FILTER (NOT failed) AS incoming, count(*) FILTER (NOT failed) AS noop_dropped,
  count(*) FILTER (failed) AS errors,
  count(*) FILTER (failed) = 0 AS clean FROM hosted""", LOGS))
def volume_accounting(spark: SparkSession, folder: str) -> DataFrame:
    """Everything discarded: incoming equals noop-dropped."""
    options = replace(OPTIONS, seed_type="noop", controller_present=False)
    return counters.accounting(routing.ledger(views.logs(spark, folder), None, options))


@query(sql("""
SELECT 'errors_total' AS metric, 'InvalidRecordKey' AS label, '' AS reason,
  count(*) FILTER (p_size % 7 = 0) AS value FROM part"""))
def invalid_key_errors(spark: SparkSession, folder: str) -> DataFrame:
    from logloom.operators.parse import pair_records

    kind = F.when(F.col("p_size") % 7 == 0, "int64").otherwise("string")
    pair = F.struct(kind.alias("key_type"), F.lit("brand").alias("key"),
                    F.col("p_brand").cast("binary").alias("value"))
    parts = views.table(spark, folder, "part").select(F.array(pair).alias("pairs"))
    return counters.invalid_key_errors(pair_records(parts))


# --- Kubernetes events ---------------------------------------------------------------------


def _kube_lines(spark: SparkSession, folder: str) -> DataFrame:
    feed = views.kube_events(spark, folder)
    every = kube_events.watched(kube_events.union_origins(feed, feed))
    return kube_events.project(kube_events.fresh(every))


@query(sql("SELECT * FROM shown", KUBE_EVENTS))
def kubernetes_events(spark: SparkSession, folder: str) -> DataFrame:
    """Fresh events of the watched namespaces of both origins."""
    return _kube_lines(spark, folder)


@query(sql("""
SELECT origin, object, _entry, CAST(count AS BIGINT) AS count,
  strftime("lastTimestamp", '%Y-%m-%dT%H:%M:%SZ') AS last,
  strftime("eventTime", '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time
FROM shown""", KUBE_EVENTS))
def kubernetes_event_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Printed event lines, read back."""
    lines = kube_events.lines(_kube_lines(spark, folder))
    schema = "origin string, object string, _entry string, count bigint, lastTimestamp string, eventTime string"
    return lines.select(F.from_json("line", schema).alias("e")).select(
        "e.origin", "e.object", "e._entry", "e.count", F.col("e.lastTimestamp").alias("last"),
        F.col("e.eventTime").alias("event_time"),
    )


# --- collectors ----------------------------------------------------------------------------

SELECTORS = (
    "", "segment=BUILDING", "segment==MACHINERY,tier!=3", "tier in (1, 2)", "tier notin (0),nation",
    "!nation", '{"matchLabels":{"tier":"2"}}',
    '{"matchExpressions":[{"key":"segment","operator":"NotIn","values":["BUILDING"]},'
    '{"key":"nation","operator":"Exists"}]}',
)


@query(sql("""
SELECT selector, count(*) AS matched FROM (
  SELECT unnest(list_filter([0, 1, 2, 3, 4, 5, 6, 7], lambda i: CASE i WHEN 0 THEN TRUE
    WHEN 1 THEN c_mktsegment = 'BUILDING'
    WHEN 2 THEN c_mktsegment = 'MACHINERY' AND c_custkey % 5 <> 3
    WHEN 3 THEN c_custkey % 5 IN (1, 2)
    WHEN 4 THEN c_custkey % 5 <> 0 AND c_nationkey % 2 = 0
    WHEN 5 THEN c_nationkey % 2 = 1
    WHEN 6 THEN c_custkey % 5 = 2
    ELSE c_mktsegment <> 'BUILDING' AND c_nationkey % 2 = 0 END)) AS selector
  FROM customer) GROUP BY ALL"""))
def label_selectors(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as labelled objects, counted per selector in one pass."""
    labels = F.map_concat(
        F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("tier"),
                     (F.col("c_custkey") % 5).cast("string")),
        F.when(F.col("c_nationkey") % 2 == 0,
               F.create_map(F.lit("nation"), F.col("c_nationkey").cast("string"))
               ).otherwise(F.create_map().cast("map<string,string>")),
    )
    customers = views.table(spark, folder, "customer").select(labels.alias("labels"))
    hits = F.array_compact(F.array(
        *(F.when(label_selector(F.col("labels"), s), F.lit(i)) for i, s in enumerate(SELECTORS))
    ))
    return customers.select(F.explode(hits).alias("selector")).groupBy("selector").agg(
        F.count(F.lit(1)).alias("matched")
    )


COLLECTORS = """
allowed AS (
  SELECT 'shoot--p--n' || n_nationkey AS namespace FROM nation WHERE n_nationkey % 3 <> 0),
collector AS (
  SELECT s_suppkey AS seq, s_suppkey % 7 = 0 OR s_suppkey % 9 = 0 AS gone,
    s_suppkey % 4 <> 0 AS fits, s_name AS name,
    CASE WHEN s_suppkey % 10 = 0 THEN 'other-' ELSE 'shoot--p--n' END || s_nationkey AS namespace
  FROM supplier)"""


@query(sql("""
SELECT seq, namespace, name FROM collector SEMI JOIN allowed USING (namespace)
WHERE fits AND NOT gone""", COLLECTORS))
def admitted_collectors(spark: SparkSession, folder: str) -> DataFrame:
    return collectors.admitted_collectors(
        views.collector_changes(spark, folder), views.namespaces(spark, folder),
        "app=logs", "role=shoot", OPTIONS,
    ).select("seq", "namespace", "name")


@query(sql("""
SELECT namespace AS host, 'collector.' || namespace || '.svc.cluster.local:4317' AS endpoint,
  TRUE AS to_shoot, FALSE AS to_seed
FROM (SELECT c.namespace, arg_max(fits AND NOT gone AND a.namespace IS NOT NULL, seq) AS live
      FROM collector c LEFT JOIN allowed a ON c.namespace = a.namespace GROUP BY c.namespace)
WHERE live""", COLLECTORS))
def collector_routes(spark: SparkSession, folder: str) -> DataFrame:
    return collectors.collector_routes(
        views.collector_changes(spark, folder), views.namespaces(spark, folder),
        "app=logs", "role=shoot", OPTIONS,
    )


# --- stored logs ---------------------------------------------------------------------------

STORED = """
stored AS (
  SELECT record_id, ts, found AS namespace,
    CASE WHEN has_k8s THEN event_type ELSE regexp_extract(rtag, '_([^_]+)-[a-z0-9]{64}', 1) END
      AS container, CASE WHEN is_empty THEN '{}' ELSE log_text END AS body,
    severity_text, CASE WHEN dynamic THEN 'shoot' ELSE 'seed' END AS origin, eid
  FROM leveled WHERE NOT failed)"""


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    return stored_logs(views.logs(spark, folder), OPTIONS)


@query(sql("""
SELECT count(*) AS count FROM stored WHERE namespace = 'shoot--p1--c7' AND container = 'view'
  AND ts > TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 240 HOURS
  AND ts <= TIMESTAMP '2024-01-20 00:00:00'""", LOGS, STORED))
def count_of_field_match(spark: SparkSession, folder: str) -> DataFrame:
    """Exact fields within a time range."""
    rows = select.last_hours(_stored(spark, folder), DAY_END, 240)
    rows = select.field_is(select.field_is(rows, "namespace", "shoot--p1--c7"), "container", "view")
    return select.count_rows(rows)


@query(sql("""
SELECT count(*) AS count FROM stored WHERE regexp_matches(namespace, 'shoot-*p[12]')""", LOGS, STORED))
def count_of_regex_match(spark: SparkSession, folder: str) -> DataFrame:
    """Unanchored regular expression on a field."""
    return select.count_rows(select.field_matches(_stored(spark, folder), "namespace", "shoot-*p[12]"))


@query(sql(r"""
SELECT namespace, count(*) AS n FROM stored
WHERE regexp_matches(namespace, '(^|\W)c1($|\W)') GROUP BY namespace""", LOGS, STORED))
def word_in_field(spark: SparkSession, folder: str) -> DataFrame:
    """Whole word: `c1` finds `…--c1`, not `…--c11`."""
    found = select.field_has(_stored(spark, folder), "namespace", "c1")
    return found.groupBy("namespace").agg(F.count(F.lit(1)).alias("n"))


@query(sql(r"""
SELECT record_id, body FROM stored WHERE regexp_matches(body, 'value 1($|\W)')""", LOGS, STORED))
def phrase_in_message(spark: SparkSession, folder: str) -> DataFrame:
    return select.message_has(_stored(spark, folder), "value 1").select("record_id", "body")


@query(sql("""
SELECT record_id, ts, body FROM stored WHERE origin = 'seed' AND severity_text = 'ERR'
ORDER BY ts, record_id LIMIT 10""", LOGS, STORED))
def first_of_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Stream selector and `limit 10`."""
    rows = select.stream_is(_stored(spark, folder), origin="seed", severity_text="ERR")
    return select.first(rows.select("record_id", "ts", "body"), 10, "ts", "record_id")


ID_PATTERN = r'id: "(?P<id>[0-9]+)"'


@query(sql(r"""
SELECT namespace, count(DISTINCT id) AS "unique" FROM (
  SELECT namespace, nullif(regexp_extract(body, 'id: "([0-9]+)"', 1), '') AS id FROM stored
  UNION ALL SELECT namespace, nullif(regexp_extract(body, 'id: "([0-9]+)"', 1), '')
  FROM stored WHERE eid % 3 = 0)
GROUP BY namespace""", LOGS, STORED))
def unique_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct record ids taken from the message; a third of the records came twice."""
    stored = _stored(spark, folder)
    twice = stored.withColumn(
        "copy", F.explode(F.when(F.col("record_id").cast("bigint") % 3 == 0, F.array(F.lit(1), F.lit(2)))
                          .otherwise(F.array(F.lit(1))))
    )
    ids = select.extract(twice, ID_PATTERN, "body", "id")
    return select.count_unique(ids, "id", "namespace")


@query(sql("""
SELECT namespace, container, count(*) AS total FROM stored
WHERE ts > TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 24 HOURS
  AND ts <= TIMESTAMP '2024-01-20 00:00:00' GROUP BY ALL""", LOGS, STORED))
def count_over_time(spark: SparkSession, folder: str) -> DataFrame:
    rows = select.last_hours(_stored(spark, folder), DAY_END, 24)
    return rows.groupBy("namespace", "container").agg(F.count(F.lit(1)).alias("total"))


@query(sql("""
SELECT namespace, expected, coalesce(n, 0) AS delivered, coalesce(n, 0) >= expected AS complete
FROM (SELECT ns AS namespace, count(*) AS expected FROM logs GROUP BY ns)
LEFT JOIN (SELECT namespace, count(*) AS n FROM stored GROUP BY namespace) USING (namespace)""",
           LOGS, STORED))
def delivery_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """Produced against stored records per namespace."""
    produced = views.table(spark, folder, "events").groupBy(
        views.namespace_of(F.col("user_id")).alias("namespace")
    ).agg(F.count(F.lit(1)).alias("expected"))
    return select.reconcile(produced, _stored(spark, folder).select("namespace"))


@query(sql("""
SELECT count(DISTINCT sha256('{"namespace":"' || namespace || '","container":"' || container
  || '","severity_text":"' || severity_text || '","origin":"' || origin || '"}')) AS streams,
  min(sha256('{"namespace":"' || namespace || '","container":"' || container
  || '","severity_text":"' || severity_text || '","origin":"' || origin || '"}')) AS first_stream
FROM stored WHERE namespace IS NOT NULL""", LOGS, STORED))
def streams_created(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct stored streams."""
    from logloom.sources.sinks import with_stream_id

    rows = _stored(spark, folder).filter("namespace is not null")
    ids = with_stream_id(rows, "namespace", "container", "severity_text", "origin")
    return ids.agg(F.count_distinct("stream_id").alias("streams"),
                   F.min("stream_id").alias("first_stream"))


# --- queues --------------------------------------------------------------------

QUEUE = """
moves AS (
  SELECT 'e' || user_id % 4 AS endpoint, ts, event_id * 2 AS seq, 1 AS change FROM events
  UNION ALL
  SELECT 'e' || user_id % 4, ts + to_minutes(event_id % 600), event_id * 2 + 1, -1 FROM events),
depths AS (
  SELECT *, CAST(sum(change) OVER (PARTITION BY endpoint ORDER BY ts, seq
    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth FROM moves)"""


def queue_depths(spark: SparkSession, folder: str) -> DataFrame:
    """Every event enters the queue of its endpoint and leaves it minutes later."""
    e = views.table(spark, folder, "events")
    left_at = F.col("ts") + F.make_dt_interval(mins=F.col("event_id") % 600)
    moves = F.array(
        F.struct(F.col("ts").alias("ts"), (F.col("event_id") * 2).alias("seq"),
                 F.lit(1).alias("change")),
        F.struct(left_at.alias("ts"), (F.col("event_id") * 2 + 1).alias("seq"),
                 F.lit(-1).alias("change")),
    )
    changes = e.select(F.concat(F.lit("e"), F.col("user_id") % 4).alias("endpoint"), F.inline(moves))
    return buffer.occupancy(changes)


@query(sql("SELECT endpoint, ts, seq, depth FROM depths", QUEUE))
def queue_occupancy(spark: SparkSession, folder: str) -> DataFrame:
    return queue_depths(spark, folder).select("endpoint", "ts", "seq", "depth")


@query(sql("SELECT endpoint, arg_max(depth, (ts, seq)) AS buffered FROM depths GROUP BY endpoint",
           QUEUE))
def buffered_now(spark: SparkSession, folder: str) -> DataFrame:
    return buffer.buffered(queue_depths(spark, folder))


TICK = "make_timestamp(CAST(floor(epoch(ts) / 30) AS BIGINT) * 30000000)"


@query(sql(f"""
SELECT endpoint, {TICK} AS tick, arg_max(depth, (ts, seq)) AS depth FROM depths GROUP BY 1, 2""",
           QUEUE))
def queue_size_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Queue depth every 30 seconds."""
    return buffer.depth_samples(queue_depths(spark, folder))


@query(sql(f"""
SELECT endpoint, {TICK} AS tick, max(depth) AS peak, count(*) AS samples FROM depths
WHERE depth >= 20 GROUP BY 1, 2""", QUEUE))
def queue_overflow(spark: SparkSession, folder: str) -> DataFrame:
    """Intervals with a queue at its limit."""
    return buffer.overflow(queue_depths(spark, folder), 20)
