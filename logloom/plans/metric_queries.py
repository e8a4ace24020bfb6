"""Queries over metric samples, alert rules and relabelling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.operators import timeseries
from logloom.operators.relabel import Rule, relabel
from logloom.plans import views
from logloom.plans.oracle import SAMPLES, sql
from logloom.plans.registry import query
from logloom.session import settle

RATES = """
increases AS (
  SELECT *, CASE WHEN value < before THEN value ELSE value - before END AS increase
  FROM (SELECT *, lag(value) OVER (PARTITION BY series ORDER BY ts) AS before FROM samples)),
rates AS (
  SELECT series, ts, value, coalesce(sum(increase) OVER (PARTITION BY series ORDER BY ts
    RANGE BETWEEN INTERVAL 3 HOURS PRECEDING AND CURRENT ROW), 0) / 10800 AS rate
  FROM increases)"""


def _rates(spark: SparkSession, folder: str) -> DataFrame:
    return timeseries.rate(views.metric_samples(spark, folder), 10_800)


@query(sql("SELECT series, ts, value, round(rate, 9) AS rate FROM rates", SAMPLES, RATES))
def counter_rate(spark: SparkSession, folder: str) -> DataFrame:
    """Per-second rate over three hours, aware of counter resets."""
    return _rates(spark, folder).withColumn("rate", F.round("rate", 9))


@query(sql("""
SELECT ts, length(series) AS label, round(sum(rate), 9) AS rate FROM rates GROUP BY ALL""",
           SAMPLES, RATES))
def rate_by_label(spark: SparkSession, folder: str) -> DataFrame:
    labelled = _rates(spark, folder).withColumn("label", F.length("series").cast("bigint"))
    return timeseries.rate_sum(labelled, "label").withColumn("rate", F.round("rate", 9))


@query(sql("""
SELECT series, ts, seq, round(value - first_value(value) OVER w, 9) AS delta
FROM gauge WINDOW w AS (PARTITION BY series ORDER BY ts
  RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW)""", SAMPLES))
def gauge_delta(spark: SparkSession, folder: str) -> DataFrame:
    changed = timeseries.delta(views.gauge_samples(spark, folder), 21_600)
    return changed.select("series", "ts", "seq", F.round("delta", 9).alias("delta"))


BUCKETS = """
bounds AS (SELECT unnest([1, 5, 10, 25, 50, 100, 'infinity'::DOUBLE]) AS le),
buckets AS (
  SELECT event_type AS series, date_trunc('day', ts)::TIMESTAMP AS ts, le,
    CAST(count(*) FILTER (value <= le) AS DOUBLE) AS value
  FROM events, bounds GROUP BY ALL),
ranked AS (
  SELECT *, coalesce(lag(value) OVER w, 0) AS below, lag(le) OVER w AS low,
    max(value) OVER (PARTITION BY series, ts) AS total
  FROM buckets WINDOW w AS (PARTITION BY series, ts ORDER BY le)),
quantiles AS (
  SELECT series, ts, q, arg_min(CASE WHEN isinf(le) THEN low
    ELSE coalesce(low, 0) + (le - coalesce(low, 0)) * (total * q - below)
         / nullif(value - below, 0) END, le) AS quantile
  FROM ranked, (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE)) v(q)
  WHERE total > 0 AND value >= total * q GROUP BY ALL)"""


@query(sql("""
SELECT series, ts, q, round(quantile, 6) AS quantile FROM quantiles""", BUCKETS))
def latency_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """p50, p95 and p99 from cumulative buckets."""
    found = timeseries.histogram_quantiles(
        views.latency_buckets(spark, folder), (0.5, 0.95, 0.99), ["series", "ts"], "value")
    return found.withColumn("quantile", F.round("quantile", 6))


# counters of a service (a quarter of the users) or type of event, from hourly counts
TRAFFIC = """
hours AS (
  SELECT KEY AS series, date_trunc('hour', ts) AS ts, le, count(*) FILTER (value <= le) AS n,
    count(*) AS enqueued, count(*) FILTER (event_type = 'error') AS errors,
    count(*) FILTER (event_id % 97 = 0) AS dropped
  FROM events, (SELECT unnest([1, 5, 10, 25, 50, 100, 'infinity'::DOUBLE]) AS le) GROUP BY ALL),
counters AS (
  SELECT series, ts, le, sum(n) OVER w AS n, sum(enqueued) OVER w AS enqueued,
    sum(errors) OVER w AS errors, sum(dropped) OVER w AS dropped
  FROM hours WINDOW w AS (PARTITION BY series, le, floor(epoch(ts) / 360000) ORDER BY ts)),
grown AS (
  SELECT series, ts, le,
    coalesce(CASE WHEN n < lag(n) OVER w THEN n ELSE n - lag(n) OVER w END, 0) AS n,
    coalesce(CASE WHEN enqueued < lag(enqueued) OVER w THEN enqueued
      ELSE enqueued - lag(enqueued) OVER w END, 0) AS enqueued,
    coalesce(CASE WHEN errors < lag(errors) OVER w THEN errors
      ELSE errors - lag(errors) OVER w END, 0) AS errors,
    coalesce(CASE WHEN dropped < lag(dropped) OVER w THEN dropped
      ELSE dropped - lag(dropped) OVER w END, 0) AS dropped
  FROM counters WINDOW w AS (PARTITION BY series, le ORDER BY ts))"""


def point(q: str, *keys: str) -> str:
    """Quantile `q` of the histograms `steady` (keys, le, n), n ascending with le."""
    by = ", ".join(keys)
    return f"""
placed AS (
  SELECT *, coalesce(lag(n) OVER w, 0) AS below, lag(le) OVER w AS low,
    max(n) OVER (PARTITION BY {by}) AS total FROM steady WINDOW w AS (PARTITION BY {by} ORDER BY le)),
points AS (
  SELECT {by}, {q} AS q, arg_min(CASE WHEN isinf(le) THEN low ELSE coalesce(low, 0)
      + (le - coalesce(low, 0)) * (total * {q} - below) / nullif(n - below, 0) END, le)
    FILTER (total > 0 AND n >= total * {q}) AS quantile
  FROM placed, (SELECT unnest([0.5::DOUBLE, 0.95, 0.99]) AS q) GROUP BY ALL)"""


@query(sql("""
SELECT series, ts, q, round(quantile, 6) AS quantile FROM points""", TRAFFIC.replace("KEY", "event_type"), """
steady AS (
  SELECT series, ts, le, max(rate) OVER (PARTITION BY series, ts ORDER BY le) AS n FROM (
    SELECT series, ts, le, sum(n) OVER (PARTITION BY series, le ORDER BY ts
      RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW) / 21600 AS rate FROM grown))""",
           point("q", "series", "ts")))
def latency_rate_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """p50, p95 and p99 of the rates of a histogram's counters over six hours."""
    histograms = views.traffic_counters(spark, folder, F.col("event_type"))
    found = timeseries.rate_quantiles(histograms, views.BOUNDS, 21_600, (0.5, 0.95, 0.99))
    return found.withColumn("quantile", F.round("quantile", 6))


HELD = """
held AS (
  SELECT series, ts, seq, value > 10 AS active,
    CASE WHEN value > 10 THEN min(CASE WHEN value > 10 THEN ts END) OVER (
      PARTITION BY series, streak) END AS active_since
  FROM (SELECT *, sum(CASE WHEN value > 10 THEN 0 ELSE 1 END) OVER (
          PARTITION BY series ORDER BY ts) AS streak FROM gauge))"""


@query(sql("""
SELECT series, ts, active, active_since,
  coalesce(epoch_us(ts) - epoch_us(active_since) >= 1800000000, FALSE) AS firing FROM held""",
           SAMPLES, HELD))
def condition_held(spark: SparkSession, folder: str) -> DataFrame:
    """Condition true without a break for half an hour."""
    samples = views.gauge_samples(spark, folder).drop("seq")
    return timeseries.held(samples, F.col("value") > 10, 1800).drop("value")


ALERT_STATES = """
short AS (
  SELECT series, ts, coalesce(sum(increase) OVER (PARTITION BY series ORDER BY ts
    RANGE BETWEEN INTERVAL 300 SECONDS PRECEDING AND CURRENT ROW), 0) / 300 AS rate FROM increases),
moved AS (
  SELECT series, ts, seq, value - first_value(value) OVER (PARTITION BY series ORDER BY ts
    RANGE BETWEEN INTERVAL 300 SECONDS PRECEDING AND CURRENT ROW) AS delta FROM gauge),
health AS (
  SELECT series, ts, NOT (value < 2 OR value % 5 = 0) AS up FROM samples),
conditions AS (
  SELECT 'LogsDropped' AS alert, 'critical' AS severity, 60 AS hold, series, ts, 0 AS seq,
    rate > 0 AS bad FROM short
  UNION ALL SELECT 'HighErrorRate', 'warning', 300, series, ts, 0, rate > 0.1 FROM short
  UNION ALL SELECT 'NoLogsSent', 'warning', 600, series, ts, 0, rate = 0 FROM short
  UNION ALL SELECT 'QueueGrowing', 'warning', 600, series, ts, seq, delta > 100 FROM moved
  UNION ALL SELECT 'QueueNearCapacity', 'warning', 300, s.series, s.ts, 0, s.value / c.clients > 400
    FROM samples s JOIN (SELECT ts, count(*) / 100 AS clients FROM samples GROUP BY ts) c USING (ts)
  UNION ALL SELECT 'PluginUnhealthy', 'critical', 120, series, ts, 0, NOT up FROM health
  UNION ALL SELECT 'HighExportLatency', 'warning', 300, series, ts, 0, quantile > 10
    FROM quantiles WHERE q = 0.95),
streaks AS (
  SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (
    PARTITION BY alert, series ORDER BY ts, seq) AS streak FROM conditions),
fired AS (
  SELECT *, bad AND epoch(ts) - epoch(min(CASE WHEN bad THEN ts END) OVER (
    PARTITION BY alert, series, streak)) >= hold AS firing FROM streaks)"""


@query(sql("""
SELECT alert, severity, series, count(*) FILTER (bad) AS active, count(*) FILTER (firing) AS firing
FROM fired GROUP BY ALL""", SAMPLES, RATES, BUCKETS, ALERT_STATES))
def alert_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The seven shipped rules with their ranges and hold times; samples active and firing."""
    samples = settle(views.metric_samples(spark, folder))
    buckets = views.latency_buckets(spark, folder)
    clients = samples.groupBy("ts").agg((F.count(F.lit(1)) / 100).alias("value")).withColumn(
        "series", F.lit("clients"))
    near = timeseries.per_scalar(samples, clients, "load").select("series", "ts", F.col("load").alias("value"))
    p95 = timeseries.histogram_quantile(buckets, 0.95, ["series", "ts"], "value")
    up = samples.withColumn("value", F.expr("if(value < 2, 0.0D, 1.0D)"))
    probe = samples.withColumn("value", F.expr("if(value % 5 = 0, 0.0D, 1.0D)"))
    rates = settle(timeseries.rate(samples, 300))
    rules = [timeseries.condition(rates, n) for n in ("LogsDropped", "HighErrorRate", "NoLogsSent")]
    rules += [
        timeseries.condition(views.gauge_samples(spark, folder), "QueueGrowing"),
        timeseries.condition(near, "QueueNearCapacity"),
        timeseries.condition(p95.withColumnRenamed("quantile", "value"), "HighExportLatency"),
        timeseries.unhealthy(up, probe),
    ]
    every = rules[0]
    for more in rules[1:]:
        every = every.unionByName(more)
    return timeseries.alerts(every).groupBy("alert", "severity", "series").agg(
        F.count_if("active").alias("active"), F.count_if("firing").alias("firing"))


@query(sql("""
SELECT CASE WHEN value > 10 THEN 'critical' WHEN value > 5 THEN 'warning' ELSE 'ok' END AS latency,
  CASE WHEN value * 10 > 400 THEN 'warning' ELSE 'ok' END AS queue,
  CASE WHEN value / 100 > 0.1 THEN 'critical' WHEN value / 100 > 0.01 THEN 'warning'
    ELSE 'ok' END AS errors, count(*) AS samples
FROM gauge GROUP BY ALL""", SAMPLES))
def threshold_levels(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("value")
    samples = views.gauge_samples(spark, folder)
    return samples.groupBy(
        timeseries.level("export_latency", value).alias("latency"),
        timeseries.level("queue_size", value * 10).alias("queue"),
        timeseries.level("error_rate", value / 100).alias("errors"),
    ).agg(F.count(F.lit(1)).alias("samples"))


LEVELS = """
ups AS (
  SELECT series, ts, v, lead(ts) OVER (PARTITION BY series ORDER BY ts, v) AS until FROM (
    SELECT user_id % 4 AS series, ts, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS v FROM events)),
pieces AS (
  SELECT series, v, day, epoch_us(least(until, day + INTERVAL 1 DAY)) - epoch_us(greatest(ts, day)) AS us
  FROM (SELECT *, unnest(generate_series(date_trunc('day', ts),
      date_trunc('day', until - INTERVAL 1 MICROSECOND), INTERVAL 1 DAY)) AS day FROM ups WHERE until > ts)),
known AS (SELECT series, day, sum(us * v) AS up, sum(us) AS known FROM pieces GROUP BY ALL),
moved AS (
  SELECT series, date_trunc('day', ts) AS day, le, sum(n) AS n, sum(enqueued) AS enqueued,
    sum(errors) AS errors, sum(dropped) AS dropped FROM grown GROUP BY ALL),
calendar AS (
  SELECT series, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS day
  FROM (SELECT series, day FROM known UNION ALL SELECT series, day FROM moved) GROUP BY series),
spans AS (SELECT unnest([7, 30]) AS days),
summed AS (
  SELECT c.series, c.day, days, le, sum(n) AS n, sum(enqueued) AS enqueued, sum(errors) AS errors,
    sum(dropped) AS dropped
  FROM calendar c, spans, moved m WHERE m.series = c.series AND m.day <= c.day
    AND m.day > c.day - to_days(days) GROUP BY ALL),
uptime AS (
  SELECT c.series, c.day, days, sum(up) / sum(known) AS availability FROM calendar c, spans, known k
  WHERE k.series = c.series AND k.day <= c.day AND k.day > c.day - to_days(days) GROUP BY ALL),
steady AS (
  SELECT series, day, days, le, max(n) OVER (PARTITION BY series, day, days ORDER BY le) AS n FROM summed)"""


@query(sql("""
SELECT series, CAST(day AS DATE) AS day, days, round(availability, 9) AS availability,
  round(errors / nullif(enqueued, 0), 9) AS error_ratio, round(quantile, 6) AS p95,
  CAST(dropped AS BIGINT) AS dropped, availability >= 0.999 AS availability_met,
  errors / nullif(enqueued, 0) < 0.001 AS errors_met, quantile < 5 AS latency_met, dropped = 0 AS no_loss
FROM (SELECT * FROM summed WHERE isinf(le)) JOIN points USING (series, day, days)
  LEFT JOIN uptime USING (series, day, days) WHERE q = 0.95""",
           TRAFFIC.replace("KEY", "user_id % 4"), LEVELS, point("q", "series", "day", "days")))
def service_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Availability, error ratio, p95 and loss of every service over the last 7 and 30 days, each day."""
    service = F.col("user_id") % 4
    up = settle(views.up_samples(spark, folder, service))
    traffic = settle(views.traffic_counters(spark, folder, service))
    found = None
    for days in (7, timeseries.SLO_DAYS):
        one = timeseries.service_levels(up, traffic, views.BOUNDS, days).withColumn("days", F.lit(days))
        found = one if found is None else found.unionByName(one)
    rounded = {c: F.round(c, n) for c, n in (("availability", 9), ("error_ratio", 9), ("p95", 6))}
    return found.withColumns(rounded).withColumn("dropped", F.col("dropped").cast("bigint"))


@query(sql("""
SELECT series, ts, rate_in, rate_out, round(rate_in - rate_out, 9) AS balance,
  round(value / 512 * 100, 9) AS used_percent FROM (
  SELECT series, ts, value, round(rate, 9) AS rate_in, round(lag(rate, 1, 0) OVER (
    PARTITION BY series ORDER BY ts), 9) AS rate_out FROM rates)""", SAMPLES, RATES))
def queue_balance(spark: SparkSession, folder: str) -> DataFrame:
    """Enqueue against dequeue rate (the same one sample later), and queue use in percent."""
    rates = _rates(spark, folder).withColumn("rate_in", F.round("rate", 9))
    both = timeseries.neighbour(rates, ["series"], ["ts"], {"rate": "out"})
    rate_out = F.round(F.coalesce("out", F.lit(0.0)), 9)
    return both.select(
        "series", "ts", "rate_in", rate_out.alias("rate_out"),
        F.round(F.col("rate_in") - rate_out, 9).alias("balance"),
        F.round(F.col("value") / 512 * 100, 9).alias("used_percent"),
    )


@query(sql("""
SELECT series, ts, snapshot, coalesce(snapshot = lag(snapshot) OVER (
  PARTITION BY series ORDER BY ts), FALSE) AS stalled
FROM (SELECT series, ts, CAST(floor(value / 10) AS BIGINT) AS snapshot FROM gauge)""", SAMPLES))
def stalled_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    snapshots = views.gauge_samples(spark, folder).select(
        "series", "ts", F.floor(F.col("value") / 10).alias("snapshot")
    )
    return timeseries.stalled(snapshots)


@query(sql("""
SELECT series, arg_max(value, ts) AS value FROM gauge WHERE seq % 7 <> 0 GROUP BY series""",
           SAMPLES))
def last_values(spark: SparkSession, folder: str) -> DataFrame:
    """Newest sample that is not null."""
    samples = views.gauge_samples(spark, folder)
    holes = samples.withColumn("value", F.when(F.col("seq") % 7 != 0, F.col("value")))
    return timeseries.last_value(holes, "series")


def _hourly(spark: SparkSession, folder: str, only: str | None = None) -> DataFrame:
    e = views.table(spark, folder, "events")
    if only:
        e = e.filter(F.col("event_type") == only)
    tick = F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("timestamp_ntz")
    return e.groupBy((F.col("user_id") % 4).alias("shard"), tick.alias("ts")).agg(
        F.count(F.lit(1)).cast("double").alias("value")
    )


@query(sql("""
SELECT shard, ts, round(e / n, 9) AS error_ratio FROM (
  SELECT user_id % 4 AS shard, date_trunc('hour', ts) AS ts, count(*) AS n,
    count(*) FILTER (event_type = 'error') AS e FROM events GROUP BY ALL) WHERE e > 0"""))
def error_ratio(spark: SparkSession, folder: str) -> DataFrame:
    """Errors over all, matched on equal labels and moments."""
    ratio = timeseries.vector_ratio(
        _hourly(spark, folder, "error"), _hourly(spark, folder), ["shard"], "error_ratio"
    )
    return ratio.withColumn("error_ratio", F.round("error_ratio", 9))


@query(sql("""
SELECT s.series, s.ts, round(s.value / c.value, 9) AS per_client
FROM samples s JOIN samples c ON s.ts = c.ts AND c.series = 'signup'""", SAMPLES))
def queue_per_client(spark: SparkSession, folder: str) -> DataFrame:
    """Each series over the one series all of them share."""
    samples = views.metric_samples(spark, folder)
    shared = samples.filter(F.col("series") == "signup")
    divided = timeseries.per_scalar(samples, shared, "per_client")
    return divided.select("series", "ts", F.round("per_client", 9).alias("per_client"))


@query(sql("""
SELECT user_id, max_value FROM (
  SELECT user_id, max(value) AS max_value FROM events WHERE event_type = 'error' AND value > 60
    GROUP BY user_id
  UNION ALL
  SELECT user_id, max(value) FROM events WHERE event_type = 'view' AND user_id NOT IN (
    SELECT user_id FROM events WHERE event_type = 'error' AND value > 60) GROUP BY user_id)"""))
def either_vector(spark: SparkSession, folder: str) -> DataFrame:
    """Left samples, and right ones whose labels the left does not have."""
    e = views.table(spark, folder, "events")

    def peak(df: DataFrame) -> DataFrame:
        return df.groupBy("user_id").agg(F.max("value").alias("max_value"))

    left = peak(e.filter("event_type = 'error' and value > 60"))
    return timeseries.vector_or(left, peak(e.filter("event_type = 'view'")), ["user_id"])


@query(sql("""
SELECT sum(value) AS total FROM (SELECT series, arg_max(value, ts) AS value FROM samples
  WHERE regexp_matches(series, 'click|view') GROUP BY series)""", SAMPLES))
def dashboard_total(spark: SparkSession, folder: str) -> DataFrame:
    """Sum over the newest samples of the matching series."""
    matching = views.metric_samples(spark, folder).filter(F.col("series").rlike("click|view"))
    return timeseries.last_value(matching, "series").agg(F.sum("value").alias("total"))


@query(sql("""
SELECT round((t.value - f.value) / nullif(t.value, 0) * 100, 6) AS used_percent,
  round(t.value / CASE WHEN f.value > 0 THEN f.value END, 6) AS compression
FROM (SELECT arg_max(value, ts) AS value FROM samples WHERE series = 'view') t,
     (SELECT arg_max(value, ts) AS value FROM samples WHERE series = 'click') f""", SAMPLES))
def dashboard_ratios(spark: SparkSession, folder: str) -> DataFrame:
    """Percent used and a guarded ratio of two newest samples."""
    newest = views.metric_samples(spark, folder).agg(
        F.max_by(F.when(F.col("series") == "view", F.col("value")),
                 F.when(F.col("series") == "view", F.col("ts"))).alias("total"),
        F.max_by(F.when(F.col("series") == "click", F.col("value")),
                 F.when(F.col("series") == "click", F.col("ts"))).alias("free"),
    )
    guarded = F.when(F.col("free") > 0, F.col("free"))
    return newest.select(
        F.round(F.try_divide(F.expr("total - free"), F.col("total")) * 100, 6).alias("used_percent"),
        F.round(F.try_divide("total", guarded), 6).alias("compression"),
    )


@query(sql("""
SELECT e.series, e.ts, round(e.rate / nullif(v.rate, 0), 6) AS average
FROM rates e JOIN rates v ON e.ts = v.ts AND v.series = 'view' WHERE e.series = 'error'""",
           SAMPLES, RATES))
def request_duration(spark: SparkSession, folder: str) -> DataFrame:
    """Rate of a sum over rate of its count."""
    rates = _rates(spark, folder).select("series", "ts", F.col("rate").alias("value"))
    over = timeseries.per_scalar(
        rates.filter("series = 'error'"), rates.filter("series = 'view'"), "average"
    )
    return over.select("series", "ts", F.round("average", 6).alias("average"))


# --- relabelling ---------------------------------------------------------------------------

RULES = (
    Rule("keep", ("kind",), "building|machinery"),
    Rule("drop", ("phase",), "closed"),
    Rule(source=("kind", "customer"), regex="building;(.*)", target="site", replacement="${1}-b"),
    Rule(source=("segment",), target="job"),
    Rule(target="endpoint", replacement="metrics"),
    Rule(source=("nothing",), target="phase"),
    Rule("labelmap", regex="label_(.+)"),
)


@query(sql("""
SELECT CASE WHEN kind = 'building' THEN 'c' || c_custkey % 5 || '-b' END AS site, kind AS job,
  'metrics' AS endpoint, CAST(NULL AS VARCHAR) AS phase, 'team-' || c_custkey % 3 AS team,
  count(*) AS targets
FROM (SELECT *, lower(c_mktsegment) AS kind FROM customer)
WHERE kind IN ('building', 'machinery') AND c_custkey % 10 <> 7 GROUP BY ALL"""))
def relabelled_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as labelled targets, through a rule of every action."""
    c = views.table(spark, folder, "customer")
    key = F.col("c_custkey")
    names = {
        "kind": F.lower("c_mktsegment"), "segment": F.lower("c_mktsegment"),
        "customer": F.concat(F.lit("c"), key % 5),
        "phase": F.when(key % 10 == 7, "closed").otherwise("open"),
        "label_team": F.concat(F.lit("team-"), key % 3),
    }
    labels = F.create_map(*(x for n, v in names.items() for x in (F.lit(n), v)))
    done = relabel(c.select(labels.alias("labels")), RULES)
    shown = ("site", "job", "endpoint", "phase", "team")
    flat = done.select(*(F.col("labels")[k].alias(k) for k in shown))
    return flat.groupBy(*shown).agg(F.count(F.lit(1)).alias("targets"))
