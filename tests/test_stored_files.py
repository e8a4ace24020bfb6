"""Files of stored logs: which a search opens, what a failed or repeated delivery leaves, lines that do not parse."""

import json

import pytest
from pyspark.sql import functions as F

from logloom import RouteOptions
from logloom.operators import buffer, counters, parse, search
from logloom.operators.parse import json_records
from logloom.plans import views
from logloom.sources import readers, records, sinks
from logloom.streaming import jobs
from logloom.streaming.log import BatchLog
from tests.conftest import TESTDATA


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store") / "logs")
    rows = [(f"2024-01-{1 + i % 5:02d} 10:{i % 60:02d}:00", f"ns {i % 3}:x%", f"pod-{i} says value {i % 7}.5 née été_{i % 11}")
            for i in range(900)]
    df = spark.createDataFrame(rows, "t string, namespace string, body string").select(
        F.col("t").cast("timestamp_ntz").alias("ts"), "namespace", "body", F.col("namespace").alias("container"))
    sinks.write_streams(sinks.with_stream_id(df, "namespace", "container"), path)
    search.write_index(spark, path, "body")
    return path, spark.read.parquet(path)


@pytest.mark.parametrize(("phrase", "files"), [
    ("pod-17 says", 1), ("pod-1", 15), ("value 3", 15), ("née", 15), ("été_3", 15), ("absent", 0), ("pod", 15), ("--", 15)])
def test_search_opens_the_files_with_the_words(spark, store, phrase, files):
    path, every = store
    assert len(every.inputFiles()) == 15
    opened = search.files_for(spark, path, {"body": phrase})
    assert len(opened) <= files + 1 and (files != 15 or len(opened) == 15)
    got = search.search(spark, path, {"body": phrase})
    from logloom.operators.select import message_has

    want = message_has(every, phrase)
    assert got.columns == every.columns and got.count() == want.count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_search_by_stream_and_time(spark, store):
    path, every = store
    stream = every.filter("namespace = 'ns 1:x%'").first().stream_id
    assert len(search.files_for(spark, path, stream_id=stream)) == 5
    span = {"since": "2024-01-02", "until": "2024-01-03 10:30:00"}
    assert len(search.files_for(spark, path, stream_id=stream, **span)) == 2
    got = search.search(spark, path, {"body": "says"}, stream, **span)
    want = every.filter(F.col("stream_id") == stream).filter(
        "ts >= timestamp_ntz'2024-01-02' and ts < timestamp_ntz'2024-01-03 10:30:00'")
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()
    assert search.search(spark, path, {"body": "absent"}).count() == 0


def read_records(spark, path):
    return sorted(r.record for r in spark.read.format(records.NAME).load(path).collect())


def test_a_task_that_fails_half_way_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "out")
    records.register(spark)
    assert spark.read.format(records.NAME).load(path).count() == 0
    rows = spark.range(40).select(F.concat(F.lit("e"), F.col("id") % 2).alias("endpoint"), F.col("id").cast("string").alias("record"))
    broken = rows.withColumn("record", F.when(F.col("record") != "35", F.col("record")).otherwise(
        F.raise_error(F.lit("lost")).cast("string")))
    with pytest.raises(Exception, match="lost"):
        broken.coalesce(1).write.format(records.NAME).option("batch", "0").mode("append").save(path)
    assert read_records(spark, path) == []
    for _ in range(2):
        rows.write.format(records.NAME).option("batch", "0").mode("append").save(path)
    rows.limit(3).write.format(records.NAME).option("batch", "1").mode("append").save(path)
    assert len(read_records(spark, path)) == 43
    records.CommittedSink(path).write(rows.limit(1).withColumn("more", F.lit("é\n")), 2)
    assert '{"endpoint":"e0","record":"0","more":"é\\n"}' in read_records(spark, path)


def test_a_stream_commits_its_batches(spark, tmp_path):
    path, source = str(tmp_path / "out"), tmp_path / "in"
    records.register(spark)
    for n in range(3):
        spark.range(n * 10, n * 10 + 10).selectExpr("'e' as endpoint", "cast(id as string) as record").coalesce(1).write.mode(
            "append").parquet(str(source))
    stream = spark.readStream.schema(records.SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(source))
    for _ in range(2):  # the second run has nothing left
        stream.writeStream.format(records.NAME).option("checkpointLocation", str(tmp_path / "c")).trigger(
            availableNow=True).start(path).awaitTermination()
    assert read_records(spark, path) == sorted(map(str, range(30)))
    assert sorted(p.name for p in (tmp_path / "out/commits").glob("*.json")) == ["0.json", "1.json", "2.json"]


def test_lines_that_do_not_parse(spark, tmp_path):
    good = {"MESSAGE": "m", "_SYSTEMD_UNIT": "kubelet.service", "__REALTIME_TIMESTAMP": "1704067200000005", "x": 1}
    bad = ['{"MESSAGE": "cut', "plain", "[1]", "7", '{"MESSAGE": "a"} tail {', "null"]
    (tmp_path / "j.json").write_text("\n".join([json.dumps(good), *bad, "", "  ", "{}"]))
    rows = readers.json_lines(spark.read, str(tmp_path), readers.JOURNAL_SCHEMA)
    failed = readers.corrupt(rows, "journal")
    assert {r.line for r in failed.collect()} >= {bad[0], bad[1], bad[2], bad[3], bad[5]}
    assert readers.parsed(rows).count() + failed.count() == 8
    assert [r.MESSAGE for r in readers.journal(spark.read, str(tmp_path)).collect()] == ["m"]
    value = failed.count()
    assert [tuple(r) for r in counters.malformed_lines(failed).collect()] == [
        ("errors_total", "MalformedLine:journal", "", value)]


def test_every_line_has_a_time(spark, tmp_path):
    (tmp_path / "a_ns_app-1.log").write_text("2024-01-01T00:00:00Z stdout F hi\nno form\nxx stdout F odd time\n")
    rows = parse.container_lines(readers.container_lines(spark.read, str(tmp_path))).collect()
    assert str(rows[0].ts) == "2024-01-01 00:00:00" and len(rows) == 3
    assert rows[1].ts == rows[2].ts and rows[1].ts.year > 2024
    alone = parse.container_lines(spark.createDataFrame([("no form",)], "value string")).first()
    assert alone.ts is not None


def test_counters_of_batches_add_up(spark, tmp_path):
    """A repeated micro-batch, failing lines and a full queue; before and after a merge."""
    work = str(tmp_path)
    options = RouteOptions(seed_type="noop", controller_present=False)
    raw = views.raw_logs(spark, TESTDATA).withColumn("ts", F.col("ts").cast("timestamp"))
    deliver = jobs.route_records(work, options, lambda: None)
    for n in (0, 1, 1):
        deliver(json_records(raw.filter(F.col("record_id").cast("bigint") % 2 == n)), n)
    (tmp_path / "j").mkdir()
    (tmp_path / "j/a.json").write_text('{"MESSAGE": "cut\n{}\n')
    lines = readers.json_lines(spark.readStream, f"{work}/j", readers.JOURNAL_SCHEMA)
    jobs.start(lines, jobs.count_corrupt(f"{work}/bad", "journal"), f"{work}/c").awaitTermination()
    from logloom.operators import routing

    whole = counters.ledger_counters(routing.ledger(json_records(raw), None, options))
    want = {tuple(r) for r in whole.collect()} | {("errors_total", "MalformedLine:journal", "", 1)}
    folders = (f"{work}/counters", f"{work}/bad/counters")
    assert {tuple(r) for r in jobs.kept_counters(spark, *folders).collect()} == want
    jobs.merge_counters(spark, folders[0])
    assert len(BatchLog(spark, folders[0]).folders()) == 1
    assert {tuple(r) for r in jobs.kept_counters(spark, *folders).collect()} == want
    depths = spark.createDataFrame([("e", 1, 1), ("e", 1, 2), ("e", 1, 3), ("e", -1, 2), ("e", 1, 3), ("f", 1, 1)],
                                   "endpoint string, change int, depth bigint")
    assert [tuple(r) for r in counters.queue_full(buffer.rejected(depths, 2)).collect()] == [
        ("dropped_logs_total", "e", "queue_full", 2)]
