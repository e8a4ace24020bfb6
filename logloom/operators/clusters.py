"""Cluster change feed to routes: lifecycle state, admission, history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.once import once
from logloom.functions.values import micros
from logloom.operators.slices import DAY, neighbour, slice_of, slice_of_micros
from logloom.options import STATE_POLICY, RouteOptions

SHOOT_SCHEMA = (
    "metadata struct<name:string,namespace:string,deletionTimestamp:string,"
    "annotations:map<string,string>>,"
    "spec struct<purpose:string,hibernation:struct<enabled:boolean>>,"
    "status struct<isHibernated:boolean,lastOperation:struct<type:string,state:string,"
    "progress:int,description:string,lastUpdateTime:string>>"
)


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def decode_shoot(df: DataFrame, json: str = "shoot_json") -> DataFrame:
    """Add `shoot` (NULL when absent or malformed) and `malformed`."""
    valid = F.try_parse_json(json).isNotNull()
    shoot = F.when(valid, F.from_json(json, SHOOT_SCHEMA))
    return once(df, shoot=shoot, malformed=F.col(json).isNotNull() & ~valid)


def operation_mark(shoot: Column, options: RouteOptions) -> Column:
    annotations = shoot["metadata"]["annotations"]
    if options.operation_annotation:
        return annotations[options.operation_annotation]
    marks = F.map_filter(annotations, lambda k, _: F.substring_index(k, "/", -1) == "operation")
    return F.get(F.map_values(marks), F.lit(0))


def shoot_predicates(shoot: Column, options: RouteOptions) -> dict[str, Column]:
    """The questions asked about one cluster, each a null-safe boolean."""
    operation = shoot["status"]["lastOperation"]
    unfinished = ~_true(operation["state"] == "Succeeded")
    mark = operation_mark(shoot, options)
    return {
        "in_hibernation": _true(shoot["spec"]["hibernation"]["enabled"]),
        "is_hibernated": _true(shoot["status"]["isHibernated"]),
        "testing": _true(shoot["spec"]["purpose"] == "testing"),
        "marked_migration": _true(mark == "migrate"),
        "in_migration": _true(operation["type"] == "Migrate") & unfinished,
        "marked_restoration": _true(mark == "restore"),
        "in_restoration": _true(operation["type"] == "Restore") & unfinished,
        "in_creation": shoot.isNotNull()
        & (operation.isNull() | (_true(operation["type"] == "Create") & unfinished)),
        "deleted": shoot["metadata"]["deletionTimestamp"].isNotNull(),
    }


def lifecycle_state(p: dict[str, Column]) -> Column:
    """First state that holds, in order of precedence."""
    return (
        F.when(p["deleted"], "deletion")
        .when(p["marked_migration"] | p["in_migration"], "migration")
        .when(p["in_restoration"] | p["marked_restoration"], "restore")
        .when(p["in_creation"], "creation")
        .when(p["in_hibernation"], F.when(p["is_hibernated"], "hibernated").otherwise("hibernating"))
        .when(p["is_hibernated"], "waking")
        .otherwise("ready")
    )


def classify_changes(changes: DataFrame, options: RouteOptions) -> DataFrame:
    """Effect of each change: `action` is `keep` (route in `state`), `remove` or `ignore`."""
    df = decode_shoot(changes)
    p = shoot_predicates(F.col("shoot"), options)
    gone = F.col("op") == "delete"
    action = (
        F.when(gone, "remove")
        .when(F.col("malformed"), "ignore")
        .when(F.col("deletion_ts").isNotNull(), "remove")
        .when(F.col("shoot").isNull(), "ignore")
        .when(p["testing"] | p["deleted"], "remove")
        .otherwise("keep")
    )
    return df.withColumns(
        {"action": action, "state": F.when(F.col("shoot").isNotNull(), lifecycle_state(p))}
    ).drop("shoot", "shoot_json", "malformed")


def policy_flags(state: Column, options: RouteOptions) -> tuple[Column, Column]:
    """(to_shoot, to_seed) of a state; nine fixed states, so a CASE and no join."""
    pairs = [options.policy[s] for s in STATE_POLICY]

    def flag(side: int) -> Column:
        on = [s for s, pair in zip(STATE_POLICY, pairs) if pair[side]]
        return state.isin(*on) if on else F.lit(False)

    return flag(0), flag(1)


def endpoint_of(host: Column, options: RouteOptions) -> Column:
    return F.concat(F.lit(options.endpoint_prefix), host, F.lit(options.endpoint_suffix))


def _with_policy(df: DataFrame, options: RouteOptions) -> DataFrame:
    to_shoot, to_seed = policy_flags(F.col("state"), options)
    return df.withColumns(
        {"to_shoot": to_shoot, "to_seed": to_seed,
         "endpoint": endpoint_of(F.col("host"), options)}
    )


def effective_changes(changes: DataFrame, options: RouteOptions) -> DataFrame:
    """Changes that have an effect: `host, ts, seq, action, state`."""
    return classify_changes(changes, options).filter("action <> 'ignore'").select(
        F.col("name").alias("host"), "ts", "seq", "action", "state"
    )


def current_routes(changes: DataFrame, options: RouteOptions) -> DataFrame:
    """One row per live cluster: the latest effective change decides. Partial aggregation."""
    return routes_of(effective_changes(changes, options), options)


def routes_of(effective: DataFrame, options: RouteOptions) -> DataFrame:
    last = effective.groupBy("host").agg(F.max_by(F.struct("action", "state"), "seq").alias("last"))
    live = last.filter("last.action = 'keep'").select("host", "last.state")
    return _with_policy(live, options)


def route_history(changes: DataFrame, options: RouteOptions, width: int = DAY) -> DataFrame:
    """Intervals `[valid_from, valid_to)` of every live route; the open end is NULL."""
    return history_of(effective_changes(changes, options), options, width)


def history_of(effective: DataFrame, options: RouteOptions, width: int = DAY) -> DataFrame:
    ended = neighbour(effective, ["host"], ["ts", "seq"], {"ts": "valid_to"}, True, width)
    live = ended.filter("action = 'keep' and (valid_to is null or valid_to > ts)")
    return _with_policy(
        live.select("host", F.col("ts").alias("valid_from"), "valid_to", "state"), options
    )


def by_slice(closed: DataFrame, width: int = DAY) -> DataFrame:
    """Repeat each closed interval for every time slice it touches, so that an as-of join can
    use (host, slice) as its key and meets only the few intervals of one slice."""
    last = slice_of_micros(micros(F.col("valid_to")) - 1, width)
    slices = F.sequence(slice_of(F.col("valid_from"), width), last)
    return closed.withColumn("_slice", F.explode(slices))
