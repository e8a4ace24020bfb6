"""All settings of the pipeline in one immutable value."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

# Metadata layout inside a container log tag.
TAG_PREFIX = r"kubernetes\.var\.log\.containers"
TAG_EXPRESSION = r"\.([^_]+)_([^_]+)_(.+)-([a-z0-9]{64})\.log$"

# Lifecycle state -> (send to shoot, send to seed).
STATE_POLICY: dict[str, tuple[bool, bool]] = {
    "creation": (True, True),
    "ready": (True, False),
    "hibernating": (False, False),
    "hibernated": (False, False),
    "waking": (True, False),
    "deletion": (True, True),
    "deleted": (True, True),
    "restore": (True, True),
    "migration": (True, True),
}

SEED_HOST = "garden"
OTEL_SCHEMA_URL = "https://opentelemetry.io/schemas/1.27.0"


@dataclass(frozen=True)
class RouteOptions:
    # metadata
    fallback_to_tag: bool = True
    drop_without_metadata: bool = True
    tag_key: str = "tag"
    tag_prefix: str = TAG_PREFIX
    tag_expression: str = TAG_EXPRESSION
    # routing
    host_path: tuple[str, ...] = ("kubernetes", "namespace_name")
    host_regex: str | None = "^shoot-"
    endpoint_prefix: str = "collector."
    endpoint_suffix: str = ".svc.cluster.local:4317"
    seed_endpoint: str = "collector-seed.svc.cluster.local:4317"
    seed_type: str = "otlp_grpc"
    shoot_type: str = "otlp_grpc"
    controller_present: bool = True
    # `<domain>/operation` annotation that marks migrate and restore; None accepts any domain
    operation_annotation: str | None = None
    policy: Mapping[str, tuple[bool, bool]] = field(default_factory=lambda: dict(STATE_POLICY))
    # log record
    origin: str = ""
    host_name: str = ""
    scope_name: str = "logloom"
    scope_version: str = ""
    scope_schema_url: str = OTEL_SCHEMA_URL

    def with_policy(self, **states: tuple[bool, bool]) -> RouteOptions:
        """Override the (to_shoot, to_seed) pair of single lifecycle states."""
        unknown = set(states) - set(STATE_POLICY)
        if unknown:
            raise ValueError(f"unknown lifecycle state: {sorted(unknown)}")
        return replace(self, policy={**self.policy, **states})

    def tag_regex(self) -> str:
        return self.tag_prefix + self.tag_expression
