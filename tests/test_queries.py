"""Every registered query against its SQL, and ledger invariants."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from logloom import RouteOptions
from logloom.operators import clusters, counters, routing
from logloom.plans import views
from logloom.plans.queries import QUERIES
from tests.conftest import TESTDATA

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{TESTDATA}/{t}.parquet'")
    return connection


def comparable(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]

    def value(v):
        return ("nan" if math.isnan(v) else round(v, 9)) if isinstance(v, float) else v

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry_points.queries()[name](spark, TESTDATA)
    rows = [tuple(r) for r in df.collect()]
    result = duck.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert comparable(rows, df.columns) == comparable(result.fetchall(), columns)


def test_entry(spark):
    assert entry_points.entry(spark).columns == [
        "host", "severity_number", "severity_text", "incoming"]


def test_each_record_has_one_disposition(spark):
    options = RouteOptions()
    routes = clusters.current_routes(views.cluster_changes(spark, TESTDATA), options)
    rows = routing.ledger(views.logs(spark, TESTDATA), routes, options)
    total = views.table(spark, TESTDATA, "events").count()
    assert rows.count() == rows.select("record_id").distinct().count() == total
    assert rows.filter("disposition is null or host is null").isEmpty()
    values = {r.metric: r.v for r in counters.ledger_counters(rows).groupBy("metric").agg(
        F.sum("value").alias("v")).collect()}
    parts = {r.disposition: r["count"] for r in rows.groupBy("disposition").count().collect()}
    assert values["incoming_logs_total"] + parts["dropped_no_metadata"] == total
    assert values["output_client_logs_total"] == routing.fan_out(rows).count()
