"""Costly work on a record is spread by the number of rows and done one time."""

import pytest
from pyspark.sql import functions as F

from logloom.operators import bloom, search, slices
from logloom.plans import io_queries, stream_queries, views
from logloom.plans.queries import QUERIES
from logloom.sources import readers, sinks
from tests.conftest import TESTDATA


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("view", ["raw_logs", "cluster_changes", "kube_events"])
def test_records_are_spread_by_their_number(spark, view, monkeypatch):
    monkeypatch.setattr(readers, "ROWS_PER_TASK", 50)
    source = "orders" if view == "kube_events" else "events"
    rows = views.table(spark, TESTDATA, source).count()
    spread = getattr(views, view)(spark, TESTDATA)
    assert f"RepartitionByExpression [{views.SPREAD[source]}" in optimized(spread)
    assert spread.rdd.getNumPartitions() == -(-rows // 50)


def test_streams_are_spread_before_their_records_are_parsed(spark, monkeypatch):
    monkeypatch.setattr(readers, "ROWS_PER_TASK", 50)
    seen = []

    def deliver(batch, batch_id):
        seen.append(batch.rdd.getNumPartitions())

    work = stream_queries._workspace(spark)
    stream = views.stream_of(spark, TESTDATA, "events")
    stream_queries._drain(views.raw_logs_of(stream), deliver, work)
    assert seen == [-(-views.table(spark, TESTDATA, "events").count() // 50)]


def test_a_line_read_back_is_written_and_parsed_once(spark):
    plan = optimized(QUERIES["stdout_lines"](spark, TESTDATA))
    assert plan.count("parseJson(value") == 1
    assert plan.count("MapType(StringType,VariantType,true),Some(UTC)).evaluate") == 1


def test_a_packed_attribute_is_looked_up_once(spark):
    plan = optimized(QUERIES["packed_records"](spark, TESTDATA))
    assert plan.count(".key = user)") == 1


def test_a_batch_delivered_twice_is_built_once(spark, monkeypatch):
    plans = []

    class Sink:
        def write(self, batch, batch_id):
            plans.append(optimized(batch))
            self.sink.write(batch, batch_id)

    make = sinks.sink_for_target

    def made(*args):
        one = Sink()
        one.sink = make(*args)
        return one

    monkeypatch.setattr(io_queries.sinks, "sink_for_target", made)
    assert QUERIES["delivered_by_sink"](spark, TESTDATA).count()
    assert len(plans) == 4 and not any("parseJson" in p for p in plans)


def test_sketches_and_exact_counts_share_one_extraction(spark):
    assert "parseJson" not in optimized(QUERIES["unique_ids_from_sketches"](spark, TESTDATA))


def test_items_of_an_index_carry_numbers_not_paths(spark, monkeypatch, tmp_path):
    kinds = []
    build = bloom.index_of

    def index_of(items):
        kinds.append(items.schema["file"].dataType.typeName())
        return build(items)

    monkeypatch.setattr(search.bloom, "index_of", index_of)
    rows = spark.sql("SELECT timestamp_ntz'2024-01-01' AS ts, concat('s', id % 3) AS stream_id, concat('w', id) AS body "
                     "FROM range(30)")
    rows.repartition(3).write.parquet(f"{tmp_path}/rows")
    search.write_index(spark, f"{tmp_path}/rows", "body")
    assert kinds == ["long"]
    assert [r.body for r in search.search(spark, f"{tmp_path}/rows", {"body": "w7"}).collect()] == ["w7"]


@pytest.mark.parametrize("query", ["record_counters", "delivery_ledger", "fan_out"])
def test_records_that_are_only_counted_are_not_rebuilt(spark, query):
    plan = optimized(QUERIES[query](spark, TESTDATA))
    assert "map_concat" not in plan and "map_filter" not in plan


def test_records_that_count_alike_are_counted_before_they_are_spread_out(spark):
    plan = optimized(QUERIES["record_counters"](spark, TESTDATA))
    below = plan[plan.index("Generate inline(concat("):]
    assert "Aggregate [host" in below


def test_a_log_line_is_cut_off_after_it_was_made_once(spark, monkeypatch, tmp_path):
    plans = []
    make = io_queries.once

    def once(df, **columns):
        plans.append(sorted(columns))
        return make(df, **columns)

    monkeypatch.setattr(io_queries, "once", once)
    io_queries.cut_lines(spark.range(20).selectExpr("id", "id * id AS square"),
                         F.col("id") % 2 == 1, f"{tmp_path}/lines")
    assert plans == [["line", "lost"]]
    lines = {r.value for r in spark.read.text(f"{tmp_path}/lines").collect()}
    assert len(lines) == 20 and sum(line.endswith("}") for line in lines) == 10
    assert '{"id":4,"square":16}' in lines


def test_rows_of_a_cut_window_are_settled_once_and_counted_by_span_first(spark, monkeypatch):
    settled, asked = [], []
    settle = slices.settle
    monkeypatch.setattr(slices, "settle", lambda df: settled.append(df) or settle(df))
    monkeypatch.setattr(slices, "ROWS", 30)
    rows = spark.sql("SELECT 'a' AS k, timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id) AS ts, id FROM range(100)")
    cut = slices.cut

    def seen(*args, **kwargs):
        asked.append(cut(*args, **kwargs))
        return asked[-1]

    monkeypatch.setattr(slices, "cut", seen)
    for width in (20 * 60_000_000, slices.HOUR):
        found = slices.running(rows, ["k"], ["ts", "id"], {"sum": ("sum", F.col("id"))}, width).collect()
        assert {r.id: r["sum"] for r in found} == {n: n * (n + 1) // 2 for n in range(100)}
    assert len(settled) == 2
    assert ["Join" in optimized(df) for df in asked] == [False, True]
