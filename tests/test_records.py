"""Severity, metadata, hosts, bodies and attributes of single records."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from logloom import RouteOptions
from logloom.functions.patterns import glob_regex, has_word, java_regex, redact_credentials
from logloom.functions.severity import severity_of, unify_severity
from logloom.functions.values import string_of
from logloom.operators import metadata, otel, parse, routing

OPTIONS = RouteOptions()
HEX = "0123456789abcdef0123456789abcdef0123456789abcdef0123456789abcdef"
TAG = f"kubernetes.var.log.containers.scaler-5c9d-x7k2p_shoot--p1--first_scaler-{HEX}.log"


def test_severity(records):
    cases = [
        ({"level": "error"}, (17, "error")), ({"level": "ERR"}, (17, "ERR")),
        ({"level": "Err"}, (9, "Err")), ({"severity": "Warning"}, (13, "Warning")),
        ({"loglevel": "trace"}, (1, "trace")), ({"log_level": "dbg"}, (5, "dbg")),
        ({"lvl": "Crit"}, (9, "Crit")), ({"lvl": "crit"}, (21, "crit")),
        ({"level": 0}, (24, "0")), ({"level": 1}, (24, "1")), ({"level": 2}, (21, "2")),
        ({"level": 3.9}, (17, "3")), ({"level": 4}, (13, "4")), ({"level": 6}, (9, "6")),
        ({"level": 7}, (5, "7")), ({"level": 99}, (9, "99")), ({}, (9, "Info")),
        ({"level": None, "severity": "debug"}, (5, "debug")),
        ({"level": {"a": 1}, "lvl": "fatal"}, (21, "fatal")),
        ({"severity": "info", "level": "error"}, (17, "error")), ({"level": ""}, (9, "")),
        ({"level": True}, (9, "Info")),
    ]
    df = records(*(c for c, _ in cases)).select("record_id", severity_of(F.col("fields")).alias("s"))
    found = {int(r.record_id): (r.s.number, r.s.text) for r in df.collect()}
    assert [found[i] for i in range(len(cases))] == [e for _, e in cases]


@pytest.mark.parametrize("given,expected", [
    (" i ", "INFO"), ("Inf", "INFO"), ("wrn", "WARN"), ("EROR", "ERR"), ("d", "DBG"),
    ("notice", "NOTICE"), ("f", "FATAL"), ("other ", "other "), (None, None),
])
def test_unified_severity(spark, given, expected):
    df = spark.createDataFrame([(given,)], "s string").select(unify_severity(F.col("s")))
    assert df.first()[0] == expected


def test_metadata_from_tag(spark):
    bad = TAG.replace("_scaler", "-scaler")
    custom = rf"^kube\.(?P<pod>[^_]+)_(?P<ns>[^_]+)_(?P<c>.+)-(?P<id>[a-z0-9]{{64}})\.log$"
    df = spark.createDataFrame([(TAG,), (bad,), (None,), (TAG + "\n",)], "tag string")
    found = [r[0] for r in df.select(
        metadata.metadata_from_tag(F.col("tag"), OPTIONS.tag_regex())).collect()]
    assert found[0].asDict() == {
        "pod_name": "scaler-5c9d-x7k2p",
        "namespace_name": "shoot--p1--first",
        "container_name": "scaler", "container_id": HEX,
    }
    assert found[1:] == [None, None, None]
    named = spark.createDataFrame([(f"kube.test-pod_default_nginx-{HEX}.log",)], "tag string")
    got = named.select(metadata.metadata_from_tag(F.col("tag"), custom)).first()[0]
    assert (got.pod_name, got.namespace_name, got.container_name) == ("test-pod", "default", "nginx")


@pytest.mark.parametrize("record,path,host", [
    ({}, ("kubernetes", "namespace_name"), ""),
    ({"kubernetes": {"foo": 1, "namespace_name": "garden"}}, (), ""),
    ({"kubernetes": {"foo": "bar"}}, ("kubernetes", "namespace_name"), ""),
    ({"kubernetes": {"namespace_name": "garden"}}, ("kubernetes", "namespace_name"), "garden"),
    ({"kubernetes": {"label": {"component": {"buzz": "value"}}}},
     ("kubernetes", "label", "component", "buzz"), "value"),
    ({"host": 12}, ("host",), "12"),
])
def test_dynamic_host(records, record, path, host):
    options = replace(OPTIONS, host_path=path)
    df = metadata.recover_metadata(records(record), options)
    found = routing.dynamic_host(F.col("fields"), options)
    assert df.select(found).first()[0] == host


@pytest.mark.parametrize("record,fallback,drop,outcome", [
    ({"kubernetes": {"namespace_name": "x"}}, False, False, ("routed", 0)),
    ({"tag": TAG}, True, False, ("routed", 0)),
    ({"tag": "bad"}, True, False, ("routed", 1)),
    ({"tag": "bad"}, True, True, ("dropped_no_metadata", 1)),
    ({"log": "x"}, False, True, ("routed", 0)),
    ({"kubernetes": None}, True, True, ("routed", 0)),
    ({}, True, False, ("dropped_empty", 1)),
])
def test_metadata_gate(records, record, fallback, drop, outcome):
    options = replace(OPTIONS, fallback_to_tag=fallback, drop_without_metadata=drop,
                      controller_present=False)
    row = routing.ledger(records(record), None, options).first()
    assert (row.disposition, len(row.errors)) == outcome


def bodies(records, *rows):
    df = records(*rows).select("record_id", otel.body_of(F.col("fields")).alias("b"))
    return [b for _, b in sorted((int(r.record_id), r.b) for r in df.collect())]


def test_bodies(records):
    wide = {f"key{i:03d}": "v" * 10 for i in range(200)}
    text = json.dumps(wide, separators=(",", ":"))
    got = bodies(
        records, {"log": "a", "message": "b"}, {"message": "b"}, {"log": 5, "message": "m"},
        {"log": {"z": 1, "a": "<&>"}}, {"x": 1}, {"log": "y" * 5000}, {"log": wide},
    )
    assert got[:3] == ["a", "b", "m"]
    assert got[3] == '{"a":"\\u003c\\u0026\\u003e","z":1}'
    assert got[4] == '{"x":1}'
    assert got[5] == "y" * 5000
    assert got[6] == text[:1024] + f"... <truncated {len(text) - 1024} bytes>"


def test_attributes(records):
    k8s = {"namespace_name": "ns", "pod_name": "", "pod_id": 7, "container_name": "c", "host": "n"}
    record = {
        "log": "x", "level": "error", "error": "lost", "n": 3, "f": 1.5, "b": True, "o": {"a": 1},
        "l": [1, 2], "z": None, "kubernetes": k8s,
    }
    options = replace(OPTIONS, origin="here", host_name="node-1")
    df = otel.to_otel(metadata.recover_metadata(records(record), options), options)
    row = df.first()
    found = [(a.key, a.value_type, next((v for v in a[2:] if v is not None), None))
             for a in row.attributes]
    assert found == [
        ("k8s.namespace.name", "string", "ns"), ("k8s.container.name", "string", "c"),
        ("k8s.node.name", "string", "n"), ("origin", "string", "here"), ("b", "bool", True),
        ("f", "float64", 1.5), ("l", "string", "<array: 2 items>"), ("level", "string", "error"),
        ("n", "int64", 3), ("o", "string", "<map: 1 keys>"), ("z", "string", "<<nil>>"),
    ]
    assert row.resource == {"host.name": "node-1"} and row.severity_number == 17
    back = otel.unpack(otel.pack(df), df.schema).first()
    assert back.attributes == row.attributes and back.body == row.body and back.ts == row.ts


def test_kubernetes_that_is_no_object(records):
    df = otel.to_otel(metadata.recover_metadata(records({"kubernetes": "x", "log": "l"}), OPTIONS),
                      OPTIONS)
    assert df.first().attributes == []


def test_container_lines(spark):
    lines = ["2024-01-01T00:00:00.5Z stdout F hello  there", "2024-01-01T00:00:00Z stderr P ",
             "2024-01-01T00:00:00Z stdin F x", "no form"]
    df = parse.container_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    rows = df.collect()
    assert (rows[0].stream, rows[0].logtag, rows[0].message) == ("stdout", "F", "hello  there")
    assert rows[0].nanos == 500_000_000 and str(rows[0].ts) == "2024-01-01 00:00:00.500000"
    assert rows[1].message == "" and rows[1].nanos == 0
    assert [r.log for r in rows] == [None, None, lines[2], lines[3]]


def test_record_transforms(records):
    df = parse.apply(
        records({"severity": " Wrn ", "log": '{"a":1}'}, {"severity": "odd"}, tag="systemd.kubelet.x"),
        parse.add_tag(), parse.unify_severity_field, parse.decode_field(),
        parse.set_constant("unit", {"systemd.kubelet.*": "kubelet.service"}),
    )
    f = F.col("fields")
    rows = df.orderBy("record_id").select(
        *(string_of(f[k]).alias(k) for k in ("severity", "tag", "unit")), F.to_json(f["log"]).alias("log")
    ).collect()
    assert tuple(rows[0]) == ("WARN", "systemd.kubelet.x", "kubelet.service", '{"a":1}')
    assert (rows[1].severity, rows[1].log) == ("odd", None)


def test_invalid_keys(spark):
    df = spark.sql("""select array(struct('string' key_type, 'a' key, cast('x' as binary) value),
        struct('int' key_type, '5' key, cast('y' as binary) value)) pairs""")
    row = parse.pair_records(df).select("invalid_keys", F.to_json("fields")).first()
    assert tuple(row) == (1, '{"a":"x"}')


def test_patterns(spark):
    assert java_regex("(?P<a>x)$") == r"(?d)(?<a>x)\z"
    df = spark.createDataFrame([("kubernetes.a", "x dev-1.", "http://u:p@h@x/y")], "t string, b string, e string")
    row = df.select(
        F.col("t").rlike(glob_regex("kubernetes.*")), F.col("t").rlike(glob_regex("kube")),
        has_word(F.col("b"), "dev-1"), has_word(F.col("b"), "dev"), has_word(F.col("b"), "de"),
        redact_credentials(F.col("e")),
    ).first()
    assert tuple(row) == (True, False, True, True, False, "http://xxxxx@x/y")


def test_recovered_metadata_is_part_of_the_record(records):
    row = metadata.recover_metadata(records({"zone": "z", "a": 1, "tag": TAG}), OPTIONS).select(
        F.to_json("fields").alias("j"), otel.body_of(F.col("fields")).alias("b")).first()
    found = json.loads(row.j)
    assert list(found) == ["a", "kubernetes", "tag", "zone"]
    assert found["kubernetes"]["namespace_name"] == "shoot--p1--first"
    assert json.loads(row.b) == found


@pytest.mark.parametrize("pattern,text,found", [
    ("^a$|^b$", "a\n", False), ("^a$|^b$", "b", True), (r"x\$y[$]$", "x$y$", True), (r"x\$y[$]$", "x$y$\n", False)])
def test_dollar_is_the_end_of_the_text(spark, pattern, text, found):
    from logloom.functions.patterns import matches

    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(matches(F.col("s"), pattern)).first()[0] is found


def test_words_spaces_and_paths(spark, records):
    df = spark.createDataFrame([("éc1",), ("é c1",)], "s string")
    assert [r[0] for r in df.select(has_word(F.col("s"), "c1")).collect()] == [False, True]
    df = spark.createDataFrame([("\tinfo \n",)], "s string")
    assert df.select(unify_severity(F.col("s"))).first()[0] == "INFO"
    options = replace(OPTIONS, host_path=("kubernetes", "labels", "app.kubernetes.io/name"))
    row = records({"kubernetes": {"labels": {"app.kubernetes.io/name": "shoot-x"}}}).select(
        routing.dynamic_host(F.col("fields"), options)).first()
    assert row[0] == "shoot-x"


def test_event_lines_escape_markup(spark):
    from logloom.operators import kube_events

    row = kube_events.lines(spark.sql("select 'x' origin, '<b> & c' _entry")).first()
    assert row.line == r'{"origin":"x","_entry":"\u003cb\u003e \u0026 c"}'


@pytest.mark.parametrize("selector,found", [
    ("k in(a,b)", True), ("k notin(a)", False), ("n>3", True), ("n > 5", False), ("n<9", True), ("k>1", False)])
def test_selector_grammar(spark, selector, found):
    from logloom.functions.selectors import label_selector

    df = spark.sql("select map('k', 'a', 'n', '5') as labels")
    assert df.select(label_selector(F.col("labels"), selector)).first()[0] is found


@pytest.mark.parametrize("path", [("kubernetes", "namespace_name"), ("kubernetes",), ("kubernetes", "x"),
                                  ("kubernetes", "namespace_name", "x"), ("zone",), ("tag",), ()])
def test_a_ledger_without_fields_decides_as_the_whole_one(spark, records, path):
    own = {"kubernetes": {"namespace_name": "shoot--q--w", "x": "shoot--x"}, "zone": "shoot--z"}
    given = records({"tag": TAG, "zone": "shoot--z"}, {"tag": "other"}, {}, own, {"kubernetes": None, "tag": TAG},
                    {"kubernetes": "x"}, {"zone": 7, "tag": TAG.replace("shoot", "other")}, {"log": "l"})
    for lost in (True, False):
        options = replace(OPTIONS, host_path=path, drop_without_metadata=lost, host_regex="^(shoot|kube)")
        hosts = routing.with_host(given, options).select("host").distinct().select(
            "host", F.lit(True).alias("to_shoot"), (F.length("host") > 10).alias("to_seed"),
            F.col("host").alias("endpoint"))
        for routes in (None, hosts):
            whole = routing.ledger(given, routes, options)
            short = routing.ledger(given, routes, options, whole=False)
            assert "fields" not in short.columns and "_found" not in short.columns
            columns = ["record_id", "host", "errors", "disposition", "destinations"]
            assert sorted(short.select(columns).collect()) == sorted(whole.select(columns).collect())
