"""The paths taken for large or skewed data, against plain computations."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from logloom import RouteOptions
from logloom.operators import clusters, routing, slices, timeseries
from logloom.operators.lookup import lookup_join
from logloom.operators.slices import neighbour, running
from logloom.plans import views
from tests.conftest import TESTDATA

START = datetime(2024, 1, 1)
MINUTE = 60_000_000


def skewed(seed=1, n=600):
    """One series holds most rows; several hours without any sample in between."""
    rng, rows, at = random.Random(seed), [], 0.0
    for i in range(n):
        at += rng.choice([0.5, 20, 200, 9000]) if rng.random() < 0.1 else rng.random() * 30
        series = "hot" if rng.random() < 0.8 else f"s{rng.randrange(3)}"
        rows.append((series, START + timedelta(seconds=at, microseconds=i), float(rng.randrange(100)), i))
    return pd.DataFrame(rows, columns=["series", "ts", "value", "seq"])


@pytest.fixture(scope="module")
def data(spark):
    pdf = skewed()
    return pdf, spark.createDataFrame(pdf, "series string, ts timestamp, value double, seq bigint")


@pytest.mark.parametrize("rows", [20, 10_000])
@pytest.mark.parametrize("ahead", [False, True])
def test_neighbour(data, ahead, rows, monkeypatch):
    monkeypatch.setattr(slices, "ROWS", rows)
    pdf, df = data
    got = neighbour(df, ["series"], ["ts", "seq"], {"value": "near"}, ahead, MINUTE).toPandas()
    want = pdf.groupby("series")["value"].shift(-1 if ahead else 1)
    got = got.set_index("seq")["near"].sort_index()
    pd.testing.assert_series_equal(got, want, check_names=False)


@pytest.mark.parametrize("rows", [20, 10_000])
def test_running(data, rows, monkeypatch):
    monkeypatch.setattr(slices, "ROWS", rows)
    pdf, df = data
    got = running(df, ["series"], ["ts", "seq"],
                  {"total": ("sum", F.col("value")), "top": ("max", F.col("value"))}, MINUTE)
    got = got.toPandas().set_index("seq").sort_index()
    by = pdf.groupby("series")["value"]
    pd.testing.assert_series_equal(got["total"], by.cumsum(), check_names=False)
    pd.testing.assert_series_equal(got["top"], by.cummax(), check_names=False)


@pytest.mark.parametrize(("seconds", "rows"), [(30, 20), (7200, 20), (30, 10_000), (300, 10_000), (7200, 10_000)])
def test_rate_and_delta(data, seconds, rows, monkeypatch):
    monkeypatch.setattr(slices, "ROWS", rows)
    pdf, df = data
    rates = timeseries.rate(df, seconds).toPandas().set_index("seq")["rate"]
    deltas = timeseries.delta(df, seconds).toPandas().set_index("seq")["delta"]
    before = pdf.groupby("series")["value"].shift(1)
    grown = (pdf.value - before).where(pdf.value >= before, pdf.value).where(before.notna(), 0)
    assert len(rates) == len(deltas) == len(pdf)
    for i, row in pdf.iterrows():
        near = pdf[(pdf.series == row.series) & (pdf.ts <= row.ts)
                   & (pdf.ts >= row.ts - timedelta(seconds=seconds))]
        assert rates[i] == pytest.approx(grown[near.index].sum() / seconds)
        assert deltas[i] == row.value - near.value.iloc[0]


def test_no_window_group_exceeds_the_target(spark, monkeypatch):
    """One key has all its rows within a minute, half of them within a second."""
    df = spark.range(4000).select(
        F.when(F.col("id") % 10 == 0, "cold").otherwise("hot").alias("series"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.when(
            F.col("id") % 2 == 0, F.col("id")).otherwise(F.col("id") * 14_000)).alias("ts"),
        F.col("id").alias("seq"), F.lit(1).cast("bigint").alias("value"))
    sliced = slices.cut(df, ["series"], "ts", 3600 * 1_000_000, rows=100)
    assert sliced.count() == 4000
    assert sliced.groupBy("series", "_slice").count().agg(F.max("count")).first()[0] <= 100
    monkeypatch.setattr(slices, "ROWS", 100)
    total = running(df, ["series"], ["ts", "seq"], {"n": ("sum", F.col("value"))})
    assert total.groupBy("series").agg(F.max("n"), F.count_distinct("n")).collect() == [
        r for r in total.groupBy("series").agg(F.count("n"), F.count("n")).collect()]


@pytest.mark.parametrize("rows", [20, 10_000])
def test_held(data, rows, monkeypatch):
    monkeypatch.setattr(slices, "ROWS", rows)
    pdf, df = data
    got = timeseries.held(df, F.col("value") > 30, 60, MINUTE).toPandas().set_index("seq")
    since = {}
    for row in pdf.itertuples():
        since[row.series] = (since.get(row.series) or row.ts) if row.value > 30 else None
        start = since[row.series]
        firing = start is not None and row.ts - start >= timedelta(seconds=60)
        assert got.loc[row.seq, "firing"] == firing


def test_salted_lookup(spark):
    facts = spark.range(2000).selectExpr("id as record_id", "if(id % 3 = 0, 'hot', concat('k', id % 50)) as host")
    table = spark.range(40).selectExpr("if(id = 0, 'hot', concat('k', id)) as host", "id as route")
    small = lookup_join(facts, table, ["host"], spread="record_id")
    large = lookup_join(facts, table, ["host"], spread="record_id", max_rows=0, rows_per_task=100)
    assert "_salt" in large._jdf.queryExecution().toString()
    assert small.count() == large.count() == 2000
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()


def test_facts_without_a_key_are_spread(spark):
    facts = spark.range(2000).selectExpr("id as record_id", "if(id % 50 = 0, 'k', null) as host")
    table = spark.sql("select 'k' as host, 1 as route union all select null, 2")
    large = lookup_join(facts, table, ["host"], spread="record_id", max_rows=0, rows_per_task=100)
    assert large.count() == 2000 and large.filter("route = 1").count() == 40 == large.filter("route is not null").count()
    shuffled = large.filter("host is null").repartition(1).select("record_id").distinct()
    assert shuffled.count() == 1960
    assert "10000" in large._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("rows", [20, 1_000_000])
def test_as_of_paths_agree(spark, rows, monkeypatch):
    monkeypatch.setattr(slices, "ROWS", rows)
    options = RouteOptions()
    history = clusters.route_history(views.cluster_changes(spark, TESTDATA), options)
    logs = views.logs(spark, TESTDATA)
    columns = ("record_id", "host", "disposition", "destinations")
    by_lookup = routing.ledger_as_of(logs, history, options).select(*columns)
    by_order = routing.ledger_as_of(logs, history, options, max_per_slice=0).select(*columns)
    assert by_lookup.count() == by_order.count() == logs.count()
    assert by_lookup.exceptAll(by_order).isEmpty()
    assert by_order.groupBy("disposition").count().count() >= 3
