"""All registered queries."""

from logloom.plans import (  # noqa: F401
    io_queries,
    metric_queries,
    record_queries,
    routing_queries,
    stream_queries,
)
from logloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
