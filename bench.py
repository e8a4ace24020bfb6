"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores. Each
query runs once to warm up, then twice; the faster run counts. Every row and column is produced.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from logloom import RouteOptions
from logloom.operators import clusters, counters, otel, routing
from logloom.plans import views
from logloom.plans.queries import QUERIES

HEADLINE = (
    "incoming_by_host_and_severity",
    "container_line_parser",
    "otel_records",
    "delivery_ledger",
    "delivery_ledger_as_of",
    "record_counters",
    "route_history",
    "kubernetes_events",
    "unique_ids",
    "queue_occupancy",
    "counter_rate",
    "condition_held",
    "latency_quantiles",
    "relabelled_targets",
)


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def route_build_and_count(spark: SparkSession, folder: str) -> None:
    """The whole way of a record: parse, route, build for each destination, count."""
    options = RouteOptions()
    routes = clusters.current_routes(views.cluster_changes(spark, folder), options)
    decided = routing.ledger(views.logs(spark, folder), routes, options)
    routed = decided.filter("disposition = 'routed'")
    consume(routing.fan_out(otel.to_otel(routed, options)))
    consume(counters.ledger_counters(decided))


def timed(work) -> float:
    started = time.perf_counter()
    work()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    work = {
        name: lambda name=name: consume(QUERIES[name](spark, folder)) for name in HEADLINE
    }
    work["route_build_and_count"] = lambda: route_build_and_count(spark, folder)
    seconds = {}
    for name, run in work.items():
        run()
        seconds[name] = min(timed(run), timed(run))
    records = views.table(spark, folder, "events").count()
    print(json.dumps({
        "metric": "headline_queries_warm_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "records": records,
        "records_per_sec_route_build_count": round(records / seconds["route_build_and_count"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
