"""Quantiles of histograms, service levels over days, and distinct counts from sketches."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logloom.operators import select, slices, timeseries

BOUNDS = (1.0, 5.0, float("inf"))


def test_quantiles_of_uneven_buckets(spark):
    rows = [([0.0, 0.0, 0.0],), ([4.0, 2.0, 8.0],), ([0.0, 0.0, 3.0],), ([2.0, 4.0, 4.0],)]
    df = spark.createDataFrame(rows, "counts array<double>")
    got = df.select(timeseries.bucket_quantiles(F.col("counts"), F.lit(list(BOUNDS)), (0.5, 1.0)).alias("q")).collect()
    assert [r.q for r in got] == [[None, None], [1.0, 5.0], [5.0, 5.0], [1.0, 5.0]]


@pytest.mark.parametrize("rows", [1, 1000])
def test_rates_of_buckets_that_reset(spark, rows, monkeypatch):
    monkeypatch.setattr(slices, "ROWS", rows)
    at = [datetime(2024, 1, 1) + timedelta(seconds=10 * i) for i in range(4)]
    counts = [[0.0, 0.0, 0.0], [2.0, 4.0, 4.0], [1.0, 5.0, 6.0], [1.0, 5.0, 6.0]]
    df = spark.createDataFrame(list(zip(["s"] * 4, at, counts)), "series string, ts timestamp_ntz, buckets array<double>")
    got = timeseries.rate_quantiles(df, BOUNDS, 10, (0.5, 0.9)).orderBy("ts", "q").collect()
    # increases: nothing; 2 4 4; 1 (reset) 1 2; nothing. The window of ten seconds takes both its ends
    assert [r.quantile and round(r.quantile, 9) for r in got] == [None, None, 1.0, 4.2, 1.0, 5.0, 1.0, 5.0]


def test_levels_slide_over_days_without_samples(spark):
    day = datetime(2024, 1, 1)
    up = [("s", day + timedelta(hours=12), 1.0), ("s", day + timedelta(days=2, hours=12), 0.0),
          ("s", day + timedelta(days=3), 1.0), ("s", day + timedelta(days=3, hours=6), 1.0)]
    counts = [(0, 0, 0, [0.0] * 3), (1, 10, 0, [10.0, 10.0, 10.0]), (1, 110, 1, [10.0, 110.0, 110.0])]
    traffic = [("s", day + timedelta(days=n), float(e), float(q), float(d), b) for n, (e, q, d, b) in zip((0, 1, 5), counts)]
    found = timeseries.service_levels(
        spark.createDataFrame(up, "series string, ts timestamp_ntz, value double"),
        spark.createDataFrame(traffic, "series string, ts timestamp_ntz, errors double, enqueued double, "
                                       "dropped double, buckets array<double>"), BOUNDS, 3)
    rows = {r.day.day: r for r in found.collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6]
    assert rows[1].availability == 1.0 and rows[1].error_ratio is None and rows[1].p95 is None
    assert rows[3].availability == pytest.approx(48 / 60) and rows[4].availability == pytest.approx(42 / 54)
    assert rows[5].availability == pytest.approx(18 / 30) and rows[6].availability == 1.0
    assert [rows[d].error_ratio for d in (2, 4, 5, 6)] == [0.1, 0.1, None, 0.0]
    assert rows[2].p95 == pytest.approx(0.95) and rows[6].p95 == pytest.approx(1 + 4 * 0.95)
    assert [rows[d].no_loss for d in (2, 6)] == [True, False] and rows[2].latency_met and not rows[3].availability_met


def test_sketches_merge_to_any_span(spark):
    ids = spark.range(60_000).select(
        (F.col("id") % 20_000).cast("string").alias("id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("ns"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 10).alias("ts"))
    rows = ids.unionByName(ids.limit(50).withColumn("id", F.lit("")))
    sketches = select.unique_sketches(rows, "id", "ns").cache()
    assert sketches.count() == 2 * 167
    for until in ("2024-01-02", "2024-02-01"):
        got = {r.ns: r.unique for r in select.unique_in(sketches, "2024-01-01", until, "ns").collect()}
        true = {r.ns: r.unique for r in select.count_unique(rows.filter(F.col("ts") < until), "id", "ns").collect()}
        assert got.keys() == true.keys()
        assert all(abs(got[k] - true[k]) <= 0.05 * true[k] for k in true)
