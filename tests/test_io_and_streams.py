"""Readers, sinks and streaming runs."""

import json

import pytest
from pyspark.sql import functions as F

from logloom import RouteOptions
from logloom.operators import otel, parse, routing
from logloom.operators.parse import json_records
from logloom.plans import views
from logloom.sources import readers, sinks
from logloom.streaming import jobs
from tests.conftest import TESTDATA

OPTIONS = RouteOptions()


def test_container_files(spark, tmp_path):
    for name in ("a_ns_app-1.log", "b_ns_noise-1.log"):
        (tmp_path / name).write_text("2024-01-01T00:00:00Z stdout F hi\n")
    df = readers.container_lines(spark.read, str(tmp_path), exclude=(f"{tmp_path}/*_noise-*.log",))
    rows = df.collect()
    tag = "kubernetes" + str(tmp_path).replace("/", ".") + ".a_ns_app-1.log"
    assert [(r.value[-2:], r.tag) for r in rows] == [("hi", tag)]


def test_journal_files(spark, tmp_path):
    entries = [{"MESSAGE": "m", "_SYSTEMD_UNIT": unit, "__REALTIME_TIMESTAMP": "1704067200000005"}
               for unit in ("kubelet.service", "other.service")]
    (tmp_path / "j.json").write_text("\n".join(map(json.dumps, entries)))
    row = parse.journal_records(readers.journal(spark.read, str(tmp_path)))
    shown = row.select("tag", F.to_json("fields").alias("j")).collect()
    assert len(shown) == 1 and shown[0].tag == "systemd.kubelet.service"
    record = json.loads(shown[0].j)
    assert record["time"] == "2024-01-01T00:00:00.5000Z" and record["log"] == "m"
    assert record["service.name"] == "kubelet.service"


def test_time_choice(spark):
    df = spark.sql("select '2024-01-01T00:00:01Z' a, 5L b union all select 'x', 5L union all select 'x', null")
    got = df.select(parse.normal_time(F.col("a"), F.col("b")).alias("t")).collect()
    assert [str(r.t) for r in got[:2]] == ["2024-01-01 00:00:01", "1970-01-01 00:00:05"]
    assert got[2].t.year >= 2024


def test_sink_choice(tmp_path):
    assert isinstance(sinks.sink_for("Stdout", "x"), sinks.StdoutSink)
    assert isinstance(sinks.sink_for("otlp_grpc", "x"), sinks.OtelSink)
    assert isinstance(sinks.sink_for("what", "x"), sinks.NoopSink)
    clients = {"SEED": "noop", "SHOOT": "otlphttp"}
    assert isinstance(sinks.sink_for_target("shoot", clients, "x"), sinks.OtelSink)
    with pytest.raises(ValueError):
        sinks.sink_for_target("other", clients, "x")


def test_sinks_replace_a_repeated_batch(spark, tmp_path, records):
    sent = routing.fan_out(routing.ledger(
        records({"log": "<a>", "kubernetes": {"namespace_name": "x"}}, {"log": "b"}), None,
        RouteOptions(fallback_to_tag=False)))
    out = sinks.sink_for("stdout", str(tmp_path / "lines"))
    for _ in range(2):
        out.write(sent, 0)
    lines = [r.value for r in spark.read.text(str(tmp_path / "lines")).collect()]
    assert len(lines) == 2
    assert '{"record":{"log":"b"},"timestamp":"2024-01-01T00:00:00.000000Z"}' in lines
    store = sinks.sink_for("otlp_grpc", str(tmp_path / "otel"))
    for _ in range(2):
        store.write(otel.to_otel(sent, OPTIONS), 0)
    stored = spark.read.parquet(str(tmp_path / "otel"))
    assert stored.count() == 2 and "endpoint=" in stored.inputFiles()[0]


def test_stream_store(spark, tmp_path):
    df = spark.sql("""select timestamp'2024-01-01' ts, ns namespace, 'c' container, 'm' body
        from values ('a'), ('a'), ('b') t(ns)""")
    sinks.write_streams(sinks.with_stream_id(df, "namespace", "container"), str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.select("stream_id").distinct().count() == 2
    assert back.filter("namespace = 'a'").count() == 2


def test_stream_equals_batch_over_many_micro_batches(spark, tmp_path):
    """Eight files, one per micro-batch, restarted half way."""
    source, work = tmp_path / "in", str(tmp_path)
    raw = views.raw_logs(spark, TESTDATA).withColumn("ts", F.col("ts").cast("timestamp"))
    raw.repartition(8).write.parquet(str(source))
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    changes = views.cluster_changes(spark, TESTDATA)
    from logloom.operators.clusters import current_routes

    routes = current_routes(changes, OPTIONS).persist()
    options = RouteOptions(seed_type="stdout", shoot_type="otlp_http")
    deliver = jobs.route_records(work, options, lambda: routes)
    failing = {"left": 3}

    def deliver_or_fail(batch, batch_id):
        deliver(batch, batch_id)
        failing["left"] -= 1
        if failing["left"] == 0:
            raise RuntimeError("lost")

    records = json_records(stream)
    with pytest.raises(Exception, match="lost"):
        jobs.start(records, deliver_or_fail, f"{work}/c").awaitTermination()
    jobs.start(records, deliver, f"{work}/c").awaitTermination()
    streamed = spark.read.parquet(f"{work}/ledger").select("record_id", "host", "disposition")
    batch = routing.ledger(json_records(raw), routes, options)
    assert streamed.count() == raw.count()
    assert streamed.exceptAll(batch.select("record_id", "host", "disposition")).isEmpty()
    sent = routing.fan_out(batch).groupBy("client").count().collect()
    sent = {r["client"]: r["count"] for r in sent}
    assert spark.read.text(f"{work}/stdout").count() == sent["stdout"]
    assert spark.read.parquet(f"{work}/otlp_http").count() == sent["otlp_http"]


def test_routes_kept_by_a_stream(spark, tmp_path):
    changes = views.cluster_changes(spark, TESTDATA).withColumn("ts", F.col("ts").cast("timestamp"))
    changes.repartition(5).write.parquet(str(tmp_path / "in"))
    stream = readers.cluster_changes(
        spark.readStream.option("maxFilesPerTrigger", 1),
        str(tmp_path / "in")).withColumn("deletion_ts", F.col("deletion_ts").cast("timestamp_ntz"))
    jobs.start(stream, jobs.keep_routes(str(tmp_path / "r")), str(tmp_path / "c")).awaitTermination()
    from logloom.operators.clusters import current_routes

    kept = jobs.latest_routes(spark, str(tmp_path / "r"), OPTIONS)
    now = current_routes(views.cluster_changes(spark, TESTDATA), OPTIONS)
    assert now.count() > 0
    assert kept.exceptAll(now).isEmpty() and now.exceptAll(kept).isEmpty()


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """The tables of the streams as folders of eight files each, in mixed order."""
    folder = tmp_path_factory.mktemp("parts")
    for name in ("events", "orders"):
        table = spark.read.parquet(f"{TESTDATA}/{name}.parquet")
        table.repartition(8).write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", ["streamed_ledger", "streamed_interval_counts",
                                  "streamed_kubernetes_events", "streamed_without_repeats"])
def test_streams_of_many_files_lose_no_row(spark, parts, monkeypatch, name):
    from logloom.plans.queries import QUERIES

    want = QUERIES[name](spark, TESTDATA)
    whole = views.stream_of
    small = lambda spark, folder, table: whole(spark, folder, table, most_bytes=1)
    monkeypatch.setattr(views, "stream_of", small)
    got = QUERIES[name](spark, parts)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
