"""logloom: Spark-native log routing, delivery accounting and log analytics."""

from logloom.options import RouteOptions

__all__ = ["RouteOptions"]
