"""What streams keep between micro-batches: stored ids, the log of route changes, mute flags."""

import pytest
from pyspark.sql import functions as F

from logloom import RouteOptions
from logloom.operators import bloom, clusters, routing
from logloom.operators.parse import json_records
from logloom.plans import views
from logloom.streaming import jobs
from logloom.streaming.log import BatchLog
from tests.conftest import TESTDATA

OPTIONS = RouteOptions()


def test_bloom_index_finds_every_item_and_few_others(spark):
    items = spark.range(40_000).select(
        F.concat(F.lit("g"), F.col("id") % 2).alias("group"), F.concat(F.lit("f"), F.col("id") % 8).alias("file"),
        F.concat(F.lit("item-"), "id").alias("item"))
    index = bloom.index_of(items.unionByName(items.limit(5).withColumn("item", F.lit(None).cast("string")))).cache()
    assert index.filter("blocks > 1").count() > 0
    found = bloom.lookups(index, items.select("group", "item"))
    true = items.select("file", "item")
    assert true.exceptAll(found.select("file", "item")).isEmpty()
    wrong = found.count() - true.count()
    assert wrong < 0.01 * 40_000 * 3  # each item is asked of three other files of its group
    assert bloom.files_with_all(index, spark.sql("select 'g1' group, 'item-1' item union all select 'g1', 'item-9'")) == ["f1"]
    none = index.filter("false")
    assert bloom.files_with_any(none, items.select("group", "item")) == []


def batch(spark, rows):
    return spark.createDataFrame(rows, "record_id string, t string").select("record_id", F.col("t").cast("timestamp").alias("ts"))


def test_repeats_over_many_batches_open_few_files(spark, tmp_path):
    path = str(tmp_path / "out")
    deliver = jobs.deliver_once(path, merge_every=5)
    for n in range(12):
        rows = [(f"r{n}-{i}", f"2024-01-0{1 + i % 3} 00:00:00") for i in range(6)] + [(None, "2024-01-01 00:00:00")] * 2
        deliver(batch(spark, rows + rows[:3]), n)
    stored = spark.read.parquet(path)
    nameless = stored.filter("record_id is null").count()
    assert stored.count() - nameless == 72 and nameless == 24 + 0
    again = batch(spark, [("r3-0", "2024-01-01 00:00:00"), ("r7-1", "2024-01-02 00:00:00"), ("new", "2024-01-02 00:00:00"),
                          (None, None), (None, None)])
    files = jobs.files_holding(again, path, 12)
    assert {f.split("/batch_id=")[1].split("/")[0] for f in files} == {"3", "7"} and len(files) == 2
    for _ in range(2):  # the batch runs twice
        deliver(again, 12)
    stored = spark.read.parquet(path)
    assert stored.filter("record_id is not null").count() == 73
    assert stored.filter("record_id is null").count() == 24 + 2
    assert BatchLog(spark, f"{path}/_index").folders()[0].endswith("base=9")


def test_batch_log_reads_base_and_deltas(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "log"))
    assert log.read() is None
    def write(n):
        log.append(spark.range(n, n + 1), n)
    def ids(before=None):
        return sorted(r.id for r in log.read(before).collect())
    for n in range(4):
        write(n)
    write(2)  # a repeated batch
    assert ids() == [0, 1, 2, 3] and ids(2) == [0, 1]
    log.merge()
    write(4)
    assert ids() == [0, 1, 2, 3, 4] and log.folders()[0].endswith("base=3")
    opened = log.read()
    log.merge()
    assert sorted(r.id for r in opened.collect()) == [0, 1, 2, 3, 4]
    assert ids() == [0, 1, 2, 3, 4] and len(log.folders()) == 1
    log.merge()
    assert ids() == [0, 1, 2, 3, 4]


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("parts")
    spark.read.parquet(f"{TESTDATA}/events.parquet").repartition(4).write.parquet(str(folder / "events.parquet"))
    return str(folder)


def test_late_records_get_the_route_of_their_time(spark, parts, tmp_path):
    """Files in mixed order, one a batch, changes and records both out of order."""
    work = str(tmp_path)
    events = views.stream_of(spark, parts, "events", most_bytes=1)
    jobs.start(views.cluster_changes_of(events), jobs.keep_routes(f"{work}/r", OPTIONS, 3), f"{work}/c1").awaitTermination()
    folders = [f.rsplit("/", 1)[1] for f in BatchLog(spark, f"{work}/r").folders()]
    assert folders == ["base=2", "delta=3"]
    batch = clusters.effective_changes(views.cluster_changes(spark, TESTDATA), OPTIONS)
    kept = jobs.kept_changes(spark, f"{work}/r")
    assert kept.count() == batch.count()
    # a delta holds the changes of its batch, however many routes there are
    assert spark.read.parquet(f"{work}/r/delta=3").count() < batch.count() / 2
    deliver = jobs.route_records(
        work, OPTIONS, lambda: jobs.known_history(spark, f"{work}/r", OPTIONS), as_of=True)
    jobs.start(json_records(views.raw_logs_of(events)), deliver, f"{work}/c2").awaitTermination()
    got = spark.read.parquet(f"{work}/ledger").select("record_id", "host", "disposition")
    history = clusters.route_history(views.cluster_changes(spark, TESTDATA), OPTIONS)
    want = routing.ledger_as_of(views.logs(spark, TESTDATA), history, OPTIONS).select("record_id", "host", "disposition")
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    now = jobs.latest_routes(spark, f"{work}/r", OPTIONS)
    want = clusters.current_routes(views.cluster_changes(spark, TESTDATA), OPTIONS)
    assert now.exceptAll(want).isEmpty() and want.exceptAll(now).isEmpty()


def test_flags_survive_a_restart_and_an_unknown_state(spark, tmp_path):
    work, schema = str(tmp_path), "host string, seq bigint, action string, state string"
    jobs.use_state_store(spark)

    def run(rows):
        n = len(list((tmp_path / "in").glob("*"))) if (tmp_path / "in").exists() else 0
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{work}/in/part={n}")
        stream = spark.readStream.schema(schema).parquet(f"{work}/in")
        jobs.start(jobs.mute_flags(stream, OPTIONS), jobs.keep_flags(f"{work}/flags", 2), f"{work}/c",
                   mode="update").awaitTermination()
        return {r.host: (r.to_shoot, r.to_seed) for r in jobs.kept_flags(spark, f"{work}/flags").collect()}

    assert run([("a", 2, "keep", "hibernated"), ("a", 1, "keep", "ready"), ("b", 3, "keep", "migration"),
                ("n", 4, "keep", None)]) == {"a": (False, False), "b": (True, True), "n": (False, False)}
    # a state nobody knows keeps what was there, also after a restart; late changes do nothing
    assert run([("b", 7, "keep", "melting"), ("a", 1, "keep", "creation"), ("c", 8, "keep", "ready")]) == {
        "a": (False, False), "b": (True, True), "n": (False, False), "c": (True, False)}
    assert run([("b", 9, "remove", None), ("a", 10, "keep", "waking"), ("c", 11, "keep", "odd")]) == {
        "a": (True, False), "n": (False, False), "c": (True, False)}
    assert spark.read.parquet(f"{work}/flags/delta=2").count() == 3
