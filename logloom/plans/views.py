"""Log, change, event and metric tables derived row by row from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logloom.functions.once import once
from logloom.operators.parse import json_records
from logloom.session import prepare
from logloom.sources.readers import spread_for_work, spread_if_narrow, tasks_for


# column that spreads a table evenly: its own unique id
SPREAD = {
    "events": "event_id", "documents": "doc_id", "orders": "o_orderkey", "lineitem": "l_orderkey",
}


def table(spark: SparkSession, folder: str, name: str, costly: bool = False) -> DataFrame:
    """A test table; spread by its number of rows if the work on each is `costly`."""
    df = prepare(spark).read.parquet(f"{folder}/{name}.parquet")
    if costly:
        return spread_for_work(df, SPREAD[name])
    return spread_if_narrow(df, SPREAD[name]) if name in SPREAD else df


def namespace_of(user_id: Column) -> Column:
    return F.when(user_id % 5 == 0, "garden").otherwise(
        F.concat(F.lit("shoot--p"), user_id % 3, F.lit("--c"), user_id % 20)
    )


def stream_of(
    spark: SparkSession, folder: str, name: str, most_bytes: int = 1 << 30
) -> DataFrame:
    """The same table as a stream of bounded micro-batches, each spread by its number of rows; its
    NTZ times become TIMESTAMP, as watermarks need."""
    stored = prepare(spark).read.parquet(f"{folder}/{name}.parquet")
    schema = stored.schema
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", most_bytes)
    path = f"{folder}/{name}.parquet"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if store.getFileStatus(at).isDirectory():
        stream = reader.parquet(path)
    else:  # a table of one file is picked out of its folder
        stream = reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    if name in SPREAD:
        size = max(store.getContentSummary(at).getLength(), 1)
        batch = -(-stored.count() * min(most_bytes, size) // size)
        stream = stream.repartition(tasks_for(spark, batch), SPREAD[name])
    times = [f.name for f in schema if f.dataType.typeName() == "timestamp_ntz"]
    return stream.withColumns({c: F.col(c).cast("timestamp") for c in times})


def raw_logs(spark: SparkSession, folder: str) -> DataFrame:
    return raw_logs_of(table(spark, folder, "events", costly=True))


def raw_logs_of(e: DataFrame) -> DataFrame:
    """`record_id, ts, tag, line`: one JSON record per event."""
    eid, kind = F.col("event_id"), F.col("event_type")
    e = once(e, _digest=F.sha2(eid.cast("string"), 256))
    digest = F.col("_digest")
    pod, ns = F.concat(F.lit("pod-"), F.col("user_id") % 10), namespace_of(F.col("user_id"))
    joint = F.when(eid % 50 == 0, "-").otherwise("_")
    whole = F.concat(F.lit("kubernetes.var.log.containers."), pod, F.lit("_"), ns, joint, kind,
                     F.lit("-"), digest, F.lit(".log"))
    e = once(e, _tag=F.when(eid % 97 != 0, whole))
    tag = F.col("_tag")
    k8s = F.struct(
        ns.alias("namespace_name"), pod.alias("pod_name"),
        F.when(eid % 3 == 0, "").otherwise(F.concat(F.lit("uid-"), eid)).alias("pod_id"),
        kind.alias("container_name"), digest.alias("container_id"),
        F.concat(F.lit("node-"), F.col("user_id") % 7).alias("host"),
    )
    record = F.struct(
        F.concat(F.lit('id: "'), eid, F.lit('" value '), F.col("value")).alias("log"),
        tag.alias("tag"),
        F.when(eid % 2 == 1, k8s).alias("kubernetes"),
        F.when(kind == "error", "ERR").alias("level"),
        F.when(kind == "click", "dbg").alias("severity"),
        F.when(kind == "view", "info").alias("lvl"),
        F.col("props").alias("props"),
        F.col("user_id").alias("user"),
        F.col("value").alias("value"),
    )
    # a number under `level` for sign-ups; the struct field is text, so it is spliced in
    line = F.to_json(record)
    line = F.when(
        kind == "signup", F.concat(F.lit('{"level":4,'), F.substr(line, F.lit(2)))
    ).otherwise(line)
    line = F.when(eid % 200 == 3, "{}").otherwise(line)
    return e.select(eid.cast("string").alias("record_id"), "ts", tag.alias("tag"), line.alias("line"))


def logs(spark: SparkSession, folder: str) -> DataFrame:
    return json_records(raw_logs(spark, folder))


def long_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as records whose `log` is an object."""
    d = table(spark, folder, "documents")
    line = F.to_json(
        F.struct(
            F.struct("text", "lang", "source").alias("log"),
            F.col("text").alias("message"),
            F.col("n_chars").alias("size"),
        )
    )
    return json_records(d.select(F.col("doc_id").cast("string").alias("record_id"), line.alias("line")))


def container_text(spark: SparkSession, folder: str) -> DataFrame:
    """Raw container log lines; every 40th has another form."""
    e = table(spark, folder, "events")
    eid = F.col("event_id")
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    stream = F.when(eid % 3 == 0, "stderr").otherwise("stdout")
    line = F.concat_ws(" ", time, stream, F.lit("F"), F.lit("user"), F.col("user_id"),
                       F.lit("did"), F.col("event_type"))
    return e.select(
        eid.cast("string").alias("record_id"),
        F.when(eid % 40 == 0, F.concat(F.lit("panic "), F.col("event_type"))).otherwise(line).alias(
            "value"
        ),
        F.col("ts").alias("file_ts"),
    )


# Journal unit by speaker.
JOURNAL_UNITS = {
    "user": "kubelet.service",
    "assistant": "containerd.service",
    "system": "node-agent.service",
}


def journal(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "conversations")
    unit = F.create_map(*(F.lit(x) for kv in JOURNAL_UNITS.items() for x in kv))[F.col("role")]
    moment = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("conv_id") * 60 + F.col("turn"))
    return c.select(
        F.concat_ws("-", "conv_id", "turn").alias("record_id"),
        moment.alias("ts"),
        (F.col("turn") * 1000).cast("bigint").alias("nanos"),
        F.concat(F.lit("systemd."), unit).alias("tag"),
        F.col("text").alias("MESSAGE"),
        F.concat(F.lit("/usr/bin/"), F.col("role")).alias("_EXE"),
        F.concat(F.col("role"), F.lit(" --conv "), F.col("conv_id")).alias("_CMDLINE"),
        F.col("conv_id").cast("string").alias("_PID"),
        F.lit("machine-1").alias("_MACHINE_ID"),
        unit.alias("_SYSTEMD_UNIT"),
        F.lit("system.slice").alias("_SYSTEMD_SLICE"),
    )


def cluster_changes(spark: SparkSession, folder: str) -> DataFrame:
    return cluster_changes_of(table(spark, folder, "events", costly=True))


def cluster_changes_of(events: DataFrame) -> DataFrame:
    e = events.filter(F.col("event_type").isin("signup", "purchase"))
    eid = F.col("event_id")
    case = eid % 12

    def operation(kind: str, state: str) -> Column:
        return F.struct(F.lit(kind).alias("type"), F.lit(state).alias("state"))

    mark = (
        F.when(case == 1, "reconcile").when(case == 7, "migrate").when(case == 9, "restore")
    )
    last = (
        F.when(case.isin(0, 9), operation("Create", "Processing"))
        .when(case == 1, operation("Create", "Succeeded"))
        .when(case.isin(2, 3, 4, 5, 7), operation("Reconcile", "Succeeded"))
        .when(case == 6, operation("Migrate", "Processing"))
        .when(case == 8, operation("Restore", "Processing"))
    )
    shoot = F.struct(
        F.struct(
            F.col("ns").alias("name"),
            F.when(case == 5, "2024-01-15T00:00:00Z").alias("deletionTimestamp"),
            F.when(mark.isNotNull(), F.create_map(F.lit("example.org/operation"), mark)).alias(
                "annotations"
            ),
        ).alias("metadata"),
        F.struct(
            F.when(eid % 11 == 0, "testing").otherwise("production").alias("purpose"),
            F.when(case.isin(2, 3), F.struct(F.lit(True).alias("enabled"))).alias("hibernation"),
        ).alias("spec"),
        F.struct(case.isin(3, 4).alias("isHibernated"), last.alias("lastOperation")).alias(
            "status"
        ),
    )
    e = e.withColumn("ns", namespace_of(F.col("user_id")))
    json = F.when(eid % 17 == 0, "{invalid}").when(case != 11, F.to_json(shoot))
    return e.select(
        eid.alias("seq"),
        "ts",
        F.when(eid % 13 == 0, "delete").otherwise("update").alias("op"),
        F.col("ns").alias("name"),
        F.when(eid % 29 == 0, F.col("ts")).alias("deletion_ts"),
        json.alias("shoot_json"),
    )


def namespaces(spark: SparkSession, folder: str) -> DataFrame:
    n, r = table(spark, folder, "nation"), table(spark, folder, "region")
    named = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    labels = F.create_map(F.lit("region"), F.col("r_name"), F.lit("role"),
                          F.when(F.col("n_nationkey") % 3 == 0, "seed").otherwise("shoot"))
    return named.select(
        F.concat(F.lit("shoot--p--n"), F.col("n_nationkey")).alias("name"), labels.alias("labels")
    )


def collector_changes(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "supplier")
    key = F.col("s_suppkey")
    prefix = F.when(key % 10 == 0, "other-").otherwise("shoot--p--n")
    labels = F.create_map(F.lit("app"), F.when(key % 4 == 0, "metrics").otherwise("logs"),
                          F.lit("name"), F.col("s_name"))
    return s.select(
        key.alias("seq"),
        F.when(key % 7 == 0, "delete").otherwise("update").alias("op"),
        F.concat(prefix, F.col("s_nationkey")).alias("namespace"),
        F.col("s_name").alias("name"),
        labels.alias("labels"),
        F.when(key % 9 == 0, F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))).alias("deletion_ts"),
    )


def kube_events(spark: SparkSession, folder: str) -> DataFrame:
    return kube_events_of(table(spark, folder, "orders", costly=True))


def kube_events_of(o: DataFrame) -> DataFrame:
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    delay = F.make_dt_interval(secs=key % 10)
    return o.select(
        F.when(key % 3 == 0, "kube-system").when(key % 3 == 1, "default").otherwise("other").alias(
            "namespace"
        ),
        F.concat(F.lit("event-"), key).alias("name"),
        F.col("o_orderdate").alias("creation_ts"),
        (F.col("o_orderdate") + delay).alias("observed_ts"),
        F.when(status == "O", "Pod").when(status == "F", "Node").otherwise("").alias("involved_kind"),
        F.concat(F.lit("obj-"), key).alias("involved_name"),
        F.substring("o_orderpriority", 3, 20).alias("reason"),
        F.when(key % 4 == 0, "").otherwise(F.concat(F.lit("order "), key)).alias("message"),
        F.when(F.col("o_orderpriority").startswith("1"), "Warning").otherwise("Normal").alias("type"),
        F.lit("kubelet").alias("source_component"),
        F.when(key % 2 == 0, F.concat(F.lit("node-"), F.col("o_custkey") % 9)).otherwise("").alias(
            "source_host"
        ),
        F.col("o_orderdate").alias("first_ts"),
        F.when(key % 5 != 0, F.col("o_orderdate") + delay).alias("last_ts"),
        F.when(key % 6 == 0, F.col("o_orderdate")).alias("event_time"),
        (key % 4).cast("int").alias("count"),
    )


def metric_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly cumulative event counts per type (`series`), reset every 100 hours."""
    e = table(spark, folder, "events")
    tick = F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("timestamp_ntz")
    hourly = e.groupBy(F.col("event_type").alias("series"), tick.alias("ts")).agg(
        F.count(F.lit(1)).cast("double").alias("n")
    )
    epoch = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 360_000)
    so_far = Window.partitionBy("series", epoch).orderBy("ts").rowsBetween(
        Window.unboundedPreceding, 0
    )
    return hourly.select("series", "ts", F.sum("n").over(so_far).alias("value"))


def gauge_samples(spark: SparkSession, folder: str) -> DataFrame:
    """The value of every event as a gauge sample of its type."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("series"), "ts", "value", F.col("event_id").alias("seq")
    )


# Bucket bounds of the latency histogram.
BOUNDS = (1.0, 5.0, 10.0, 25.0, 50.0, 100.0, float("inf"))


def latency_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """Cumulative histogram of event values per day and type: (series, ts, le, value)."""
    e = table(spark, folder, "events")
    day = F.date_trunc("day", F.col("ts").cast("timestamp")).cast("timestamp_ntz")
    counts = e.groupBy(F.col("event_type").alias("series"), day.alias("ts")).agg(
        *(F.count_if(F.col("value") <= b).cast("double").alias(f"b{i}")
          for i, b in enumerate(BOUNDS))
    )
    pairs = F.array(
        *(F.struct(F.lit(b).alias("le"), F.col(f"b{i}").alias("value"))
          for i, b in enumerate(BOUNDS))
    )
    return counts.select("series", "ts", F.inline(pairs))


def _reset_hourly(hourly: DataFrame, *columns: str) -> DataFrame:
    """Counts of an hour as counters that begin anew every 100 hours."""
    epoch = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 360_000)
    so_far = Window.partitionBy("series", epoch).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    return hourly.select("series", "ts", *(F.sum(c).over(so_far).alias(c) for c in columns))


def traffic_counters(spark: SparkSession, folder: str, series: Column) -> DataFrame:
    """Hourly counters of `series` with a histogram of values: (series, ts, errors, enqueued, dropped, buckets)."""
    e = table(spark, folder, "events")
    tick = F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("timestamp_ntz")
    bounds = {f"b{i}": F.count_if(F.col("value") <= b) for i, b in enumerate(BOUNDS)}
    counts = {"errors": F.count_if(F.col("event_type") == "error"), "enqueued": F.count(F.lit(1)),
              "dropped": F.count_if(F.col("event_id") % 97 == 0), **bounds}
    hourly = e.groupBy(series.alias("series"), tick.alias("ts")).agg(
        *(v.cast("double").alias(n) for n, v in counts.items()))
    return _reset_hourly(hourly, *counts).select(
        "series", "ts", "errors", "enqueued", "dropped", F.array(*bounds).alias("buckets"))


def up_samples(spark: SparkSession, folder: str, series: Column) -> DataFrame:
    """Whether each event of `series` was no error, as samples of a step function."""
    return table(spark, folder, "events").select(
        series.alias("series"), "ts", F.when(F.col("event_type") == "error", 0.0).otherwise(1.0).alias("value"))
