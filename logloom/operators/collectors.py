"""Routes from collector and namespace feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.patterns import matches
from logloom.functions.selectors import label_selector
from logloom.operators.clusters import endpoint_of
from logloom.operators.lookup import lookup_join
from logloom.options import RouteOptions


def allowed_namespaces(namespaces: DataFrame, selector: str, options: RouteOptions) -> DataFrame:
    """Existing namespaces whose name and labels fit."""
    named = matches(F.col("name"), options.host_regex or "")
    return namespaces.filter(named & label_selector(F.col("labels"), selector)).select(
        F.col("name").alias("namespace")
    ).distinct()


def admitted_collectors(
    changes: DataFrame, namespaces: DataFrame, selector: str, namespace_selector: str,
    options: RouteOptions,
) -> DataFrame:
    """Changes of collectors that are alive and fit, in allowed namespaces (left semi)."""
    alive = changes.filter((F.col("op") != "delete") & F.col("deletion_ts").isNull())
    fitting = alive.filter(label_selector(F.col("labels"), selector))
    allowed = allowed_namespaces(namespaces, namespace_selector, options)
    return lookup_join(fitting, allowed, ["namespace"], "left_semi", spread="seq")


def collector_routes(
    changes: DataFrame, namespaces: DataFrame, selector: str, namespace_selector: str,
    options: RouteOptions,
) -> DataFrame:
    """Live routes by namespace. Collectors of one namespace share its route: the last change
    of any of them decides, so deleting one removes the route until another one changes."""
    allowed = allowed_namespaces(namespaces, namespace_selector, options).withColumn(
        "allowed", F.lit(True)
    )
    marked = lookup_join(changes, allowed, ["namespace"], spread="seq")
    keep = (
        (F.col("op") != "delete") & F.col("deletion_ts").isNull()
        & label_selector(F.col("labels"), selector) & F.coalesce("allowed", F.lit(False))
    )
    last = marked.groupBy("namespace").agg(F.max_by(keep, "seq").alias("live"))
    return last.filter("live").select(
        F.col("namespace").alias("host"),
        endpoint_of(F.col("namespace"), options).alias("endpoint"),
        F.lit(True).alias("to_shoot"),
        F.lit(False).alias("to_seed"),
    )
