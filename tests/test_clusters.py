"""Cluster states, policy, selectors, collectors and event lines."""

import json

import pytest
from pyspark.sql import functions as F

from logloom import RouteOptions
from logloom.functions.selectors import label_selector
from logloom.operators import clusters, collectors, kube_events

OPTIONS = RouteOptions()
CHANGE = "seq bigint, ts timestamp_ntz, op string, name string, deletion_ts timestamp_ntz, shoot_json string"


def shoot(kind=None, state=None, mark=None, enabled=None, hibernated=False, deleted=None, purpose=None):
    operation = {"type": kind, "state": state} if kind else None
    return json.dumps({
        "metadata": {"deletionTimestamp": deleted,
                     "annotations": {"example.org/operation": mark} if mark else None},
        "spec": {"purpose": purpose, "hibernation": None if enabled is None else {"enabled": enabled}},
        "status": {"isHibernated": hibernated, "lastOperation": operation},
    })


def changes(spark, *rows):
    """(op, json) pairs of one cluster, a second apart."""
    data = [(i, op, j) for i, (op, j) in enumerate(rows)]
    df = spark.createDataFrame(data, "seq bigint, op string, shoot_json string")
    return df.selectExpr(
        "seq", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, seq) as ts", "op",
        "'shoot--a' as name", "cast(null as timestamp_ntz) as deletion_ts", "shoot_json",
    )


@pytest.mark.parametrize("json_text,state", [
    (shoot("Create", "Processing"), "creation"),
    (shoot("Create", "Succeeded", mark="reconcile"), "ready"),
    (shoot("Reconcile", "Succeeded", enabled=True), "hibernating"),
    (shoot("Reconcile", "Succeeded", enabled=True, hibernated=True), "hibernated"),
    (shoot("Reconcile", "Succeeded", enabled=False, hibernated=True), "waking"),
    (shoot("Migrate", "Processing", deleted="2024-01-01T00:00:00Z", mark="migrate"), "deletion"),
    (shoot("Migrate", "Processing"), "migration"), (shoot("Migrate", "Succeeded"), "ready"),
    (shoot("Reconcile", "Succeeded", mark="migrate"), "migration"),
    (shoot("Restore", "Processing"), "restore"),
    (shoot("Create", "Processing", mark="restore"), "restore"),
    (shoot(), "creation"), (shoot("Reconcile", "Succeeded"), "ready"),
])
def test_states(spark, json_text, state):
    row = clusters.classify_changes(changes(spark, ("update", json_text)), OPTIONS).first()
    assert row.state == state


@pytest.mark.parametrize("rows,state", [
    ([("update", shoot("Create", "Succeeded", purpose="development"))], "ready"),
    ([("update", shoot("Create", "Succeeded", purpose="testing"))], None),
    ([("update", shoot("Create", "Succeeded")), ("update", "{invalid}")], "ready"),
    ([("update", shoot("Create", "Succeeded")), ("update", None)], "ready"),
    ([("update", shoot("Create", "Succeeded")), ("delete", None)], None),
    ([("delete", None), ("update", shoot("Create", "Processing"))], "creation"),
])
def test_admission(spark, rows, state):
    routes = clusters.current_routes(changes(spark, *rows), OPTIONS).collect()
    assert [r.state for r in routes] == ([state] if state else [])


@pytest.mark.parametrize("state,to_shoot,to_seed", [
    ("creation", True, True), ("ready", True, False), ("hibernating", False, False),
    ("hibernated", False, False), ("waking", True, False), ("deletion", True, True),
    ("deleted", True, True), ("restore", True, True), ("migration", True, True),
])
def test_policy(spark, state, to_shoot, to_seed):
    df = spark.range(1).select(*clusters.policy_flags(F.lit(state), OPTIONS))
    assert tuple(df.first()) == (to_shoot, to_seed)


def test_policy_override():
    assert OPTIONS.with_policy(ready=(False, True)).policy["ready"] == (False, True)
    with pytest.raises(ValueError):
        OPTIONS.with_policy(asleep=(True, True))


LABELS = {"app": "logs", "tier": "2"}


@pytest.mark.parametrize("selector,expected", [
    ("", True), ("app=logs", True), ("app==logs,tier!=3", True), ("app!=logs", False),
    ("none!=x", True), ("tier in (1, 2)", True), ("tier notin (1,2)", False),
    ("none notin (a)", True), ("none in (a)", False), ("app", True), ("!app", False),
    ("!none", True), ('{"matchLabels":{"app":"logs"}}', True),
    ('{"matchExpressions":[{"key":"tier","operator":"In","values":["9"]}]}', False),
    ('{"matchExpressions":[{"key":"none","operator":"DoesNotExist"}]}', True),
])
def test_selectors(spark, selector, expected):
    df = spark.createDataFrame([(LABELS,)], "labels map<string,string>")
    assert df.select(label_selector(F.col("labels"), selector)).first()[0] is expected


@pytest.mark.parametrize("selector", ["a b", "=x", "{bad", "a in ()x",
                                      '{"matchExpressions":[{"key":"a","operator":"Is"}]}'])
def test_bad_selectors(selector):
    with pytest.raises(ValueError):
        label_selector(F.lit(None), selector)


def test_collectors(spark):
    ns = spark.createDataFrame(
        [("shoot--a", {"role": "shoot"}), ("shoot--b", {"role": "seed"}), ("kube", {"role": "shoot"})],
        "name string, labels map<string,string>")
    rows = [
        (1, "update", "shoot--a", "one", {"app": "logs"}, None),
        (2, "update", "shoot--b", "two", {"app": "logs"}, None),
        (3, "update", "kube", "three", {"app": "logs"}, None),
        (4, "update", "shoot--x", "four", {"app": "logs"}, None),
    ]
    schema = ("seq bigint, op string, namespace string, name string, labels map<string,string>, "
              "deletion_ts timestamp_ntz")
    args = (ns, "app=logs", "role=shoot", OPTIONS)

    def hosts(*more):
        df = spark.createDataFrame([*rows, *more], schema)
        return [r.host for r in collectors.collector_routes(df, *args).collect()]

    assert hosts() == ["shoot--a"]
    # two collectors share the route; deleting either removes it, a later change restores it
    two = (5, "update", "shoot--a", "five", {"app": "logs"}, None)
    gone = (6, "delete", "shoot--a", "one", {"app": "logs"}, None)
    assert hosts(two, gone) == []
    assert hosts(two, gone, (7, "update", "shoot--a", "five", {"app": "logs"}, None)) == ["shoot--a"]
    assert hosts((8, "update", "shoot--a", "one", {"app": "other"}, None)) == []


def test_event_lines(spark):
    df = spark.sql("""select 'kube-system' namespace, 'e' name, timestamp'2024-01-01' creation_ts,
        timestamp'2024-01-01' + make_dt_interval(0,0,0,age) observed_ts, kind involved_kind,
        'p' involved_name, 'Started' reason, '' message, 'Normal' type, 'kubelet' source_component,
        '' source_host, timestamp'2024-01-01' first_ts, cast(null as timestamp) last_ts,
        timestamp'2024-01-01 00:00:00.5' event_time, n count
        from values (0, 'Pod', 0), (5.0, '', 2), (5.000001, 'Pod', 1) t(age, kind, n)""")
    shown = kube_events.lines(kube_events.project(kube_events.fresh(kube_events.union_origins(df))))
    got = [json.loads(r.line) for r in shown.collect()]
    assert len(got) == 2
    assert got[0] == {"origin": "seed", "namespace": "kube-system", "type": "Normal",
                      "eventTime": "2024-01-01T00:00:00.500000Z", "reason": "Started",
                      "firstTimestamp": "2024-01-01T00:00:00Z", "object": "Pod/p", "source": "kubelet"}
    assert got[1]["object"] == "p" and got[1]["count"] == 2
