"""Kubernetes events to flat log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.values import html_safe

# Watched namespaces by origin.
NAMESPACES = {"seed": ("kube-system",), "shoot": ("kube-system", "default")}
MAX_AGE_SECONDS = 5


def union_origins(seed: DataFrame, shoot: DataFrame | None = None) -> DataFrame:
    """One feed of the seed's events and, if a shoot is configured, of the shoot's."""
    feed = seed.withColumn("origin", F.lit("seed"))
    if shoot is not None:
        feed = feed.unionByName(shoot.withColumn("origin", F.lit("shoot")))
    return feed


def watched(df: DataFrame, namespaces: dict[str, tuple[str, ...]] = NAMESPACES) -> DataFrame:
    """Only events of the namespaces watched for their origin."""
    keep = F.lit(False)
    for origin, names in namespaces.items():
        keep = keep | ((F.col("origin") == origin) & F.col("namespace").isin(*names))
    return df.filter(keep)


def fresh(df: DataFrame, observed: Column | None = None) -> DataFrame:
    """Drop events more than five seconds old when seen; streams compare with the clock."""
    observed = F.col("observed_ts") if observed is None else observed
    age_limit = F.make_dt_interval(secs=F.lit(MAX_AGE_SECONDS))
    return df.filter(observed <= F.col("creation_ts") + age_limit)


def _filled(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def project(df: DataFrame) -> DataFrame:
    """The twelve output columns; values to be left out are NULL."""
    return df.select(
        "origin",
        "namespace",
        _filled("type").alias("type"),
        F.nullif(F.col("count"), F.lit(0)).alias("count"),
        F.col("event_time").alias("eventTime"),
        F.col("first_ts").alias("firstTimestamp"),
        F.col("last_ts").alias("lastTimestamp"),
        _filled("reason").alias("reason"),
        F.concat_ws("/", _filled("involved_kind"), F.col("involved_name")).alias("object"),
        _filled("message").alias("_entry"),
        _filled("source_component").alias("source"),
        _filled("source_host").alias("sourceHost"),
    )


def lines(projected: DataFrame) -> DataFrame:
    """One JSON text per event (`line`), empty fields left out."""
    formats = {"eventTime": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"}
    plain = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    times = ("eventTime", "firstTimestamp", "lastTimestamp")
    shown = [
        F.date_format(c, formats.get(c, plain)).alias(c) if c in times else F.col(c)
        for c in projected.columns
    ]
    return projected.select(html_safe(F.to_json(F.struct(*shown))).alias("line"))
