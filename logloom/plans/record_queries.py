"""Queries over raw input and single records: parsing, metadata, severity, log records."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.once import once
from logloom.functions.patterns import redact_credentials
from logloom.functions.severity import severity_of, severity_of_number, unify_severity
from logloom.functions.values import string_of
from logloom.operators import metadata, otel, parse, routing, select
from logloom.options import RouteOptions
from logloom.plans import views
from logloom.plans.oracle import LOGS, TAG_RE, sql
from logloom.plans.registry import query

OPTIONS = RouteOptions()
DAY_END = "2024-01-20 00:00:00"


@query(sql("""
SELECT host, severity_number, severity_text, count(*) AS incoming FROM leveled
WHERE NOT failed AND ts > TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 24 HOURS
  AND ts <= TIMESTAMP '2024-01-20 00:00:00'
GROUP BY ALL""", LOGS))
def incoming_by_host_and_severity(spark: SparkSession, folder: str) -> DataFrame:
    """Records counted as incoming in the last 24 hours."""
    recent = select.last_hours(views.logs(spark, folder), DAY_END, 24)
    hosted = routing.with_host(recent, OPTIONS).filter(~F.col("lost_metadata"))
    leveled = hosted.withColumn("s", severity_of(F.col("fields")))
    return leveled.groupBy(
        "host", F.col("s.number").alias("severity_number"), F.col("s.text").alias("severity_text")
    ).agg(F.count(F.lit(1)).alias("incoming"))


@query(sql("""
SELECT record_id, time, stream, logtag, message, log, ts FROM (
  SELECT CAST(event_id AS VARCHAR) AS record_id, event_id % 40 <> 0 AS fits,
    CASE WHEN fits THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS time,
    CASE WHEN fits THEN CASE WHEN event_id % 3 = 0 THEN 'stderr' ELSE 'stdout' END END AS stream,
    CASE WHEN fits THEN 'F' END AS logtag,
    CASE WHEN fits THEN 'user ' || user_id || ' did ' || event_type END AS message,
    CASE WHEN NOT fits THEN 'panic ' || event_type END AS log, ts
  FROM events)"""))
def container_line_parser(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parse.container_lines(views.container_text(spark, folder))
    return parsed.drop("nanos").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(sql("""
SELECT CAST(event_id AS VARCHAR) AS record_id,
  CASE WHEN event_id % 40 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.'
    || ((epoch_us(ts) % 1000000) * 1000) || 'Z' END AS time,
  'kubernetes.a' || (event_id % 4) AS tag,
  CASE WHEN event_id % 40 <> 0 THEN 'user ' || user_id || ' did ' || event_type
       ELSE 'panic ' || event_type END AS body
FROM events"""))
def tagged_container_records(spark: SparkSession, folder: str) -> DataFrame:
    """Container records after the shipped transforms (tag, time, severity)."""
    lines = views.container_text(spark, folder).withColumn(
        "tag", F.concat(F.lit("kubernetes.a"), F.col("record_id").cast("bigint") % 4)
    )
    records = parse.apply(
        parse.container_records(parse.container_lines(lines)),
        parse.add_tag(), parse.set_time, parse.unify_severity_field,
    )
    fields = F.col("fields")
    return records.select(
        "record_id", string_of(fields["time"]).alias("time"), string_of(fields["tag"]).alias("tag"),
        otel.body_of(fields).alias("body"),
    )


@query(sql("""
SELECT CAST(event_id AS VARCHAR) AS record_id, replace(props, ' ', '') AS body FROM events"""))
def decoded_log_field(spark: SparkSession, folder: str) -> DataFrame:
    """JSON text under `log` is decoded before the body is taken."""
    e = views.table(spark, folder, "events")
    line = F.to_json(F.struct(F.col("props").alias("log")))
    records = parse.json_records(e.select(F.col("event_id").cast("string").alias("record_id"),
                                          line.alias("line")))
    return parse.apply(records, parse.decode_field()).select(
        "record_id", otel.body_of(F.col("fields")).alias("body")
    )


@query(sql("""
SELECT count(*) AS records, CAST(sum(size_n) AS BIGINT) AS kept, CAST(sum(3 - size_n) AS BIGINT)
  AS invalid_keys, count(DISTINCT name) AS names
FROM (SELECT CASE WHEN p_partkey % 7 = 0 THEN 2 ELSE 3 END AS size_n, p_name AS name FROM part)"""))
def string_keys_only(spark: SparkSession, folder: str) -> DataFrame:
    """Typed pairs to records; every seventh part has one integer key."""
    p = views.table(spark, folder, "part")

    def pair(kind, key, value):
        return F.struct(kind.alias("key_type"), F.lit(key).alias("key"),
                        value.cast("string").cast("binary").alias("value"))

    text = F.lit("string")
    kind = F.when(F.col("p_partkey") % 7 == 0, "int").otherwise("string")
    pairs = F.array(pair(text, "log", F.col("p_name")), pair(kind, "size", F.col("p_size")),
                    pair(text, "brand", F.col("p_brand")))
    records = parse.pair_records(p.select(pairs.alias("pairs")))
    return records.agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.size("fields").cast("bigint")).alias("kept"),
        F.sum(F.col("invalid_keys").cast("bigint")).alias("invalid_keys"),
        F.count_distinct(string_of(F.col("fields")["log"])).alias("names"),
    )


@query(sql("""
SELECT CAST(o_orderkey AS VARCHAR) AS record_id,
  CASE o_orderkey % 3 WHEN 2 THEN make_timestamp((1704067200 + o_orderkey) * 1000000)
       ELSE o_orderdate END AS ts
FROM orders"""))
def normalised_times(spark: SparkSession, folder: str) -> DataFrame:
    """Text time where it parses, else unix seconds."""
    o = views.table(spark, folder, "orders")
    key = F.col("o_orderkey")
    text = F.when(key % 3 == 2, "not a time").otherwise(F.col("o_orderdate").cast("string"))
    ts = parse.normal_time(text, 1_704_067_200 + key)
    return o.select(key.cast("string").alias("record_id"), ts.cast("timestamp_ntz").alias("ts"))


@query(sql("""
SELECT conv_id || '-' || turn AS record_id, text AS log, '/usr/bin/' || role AS command,
  role || ' --conv ' || conv_id AS command_line, CAST(conv_id AS VARCHAR) AS pid,
  CASE role WHEN 'user' THEN 'kubelet.service' WHEN 'assistant' THEN 'containerd.service'
       WHEN 'system' THEN 'node-agent.service' END AS service,
  CASE role WHEN 'user' THEN 'kubelet.service' WHEN 'assistant' THEN 'containerd.service' END
    AS unit,
  strftime(make_timestamp((1704067200 + conv_id * 60 + turn) * 1000000), '%Y-%m-%dT%H:%M:%S')
    || '.' || (turn * 1000) || 'Z' AS time
FROM conversations WHERE role IN ('user', 'assistant', 'system')"""))
def journal_records(spark: SparkSession, folder: str) -> DataFrame:
    """Journal entries of the watched units, reprojected, with the unit set by tag."""
    entries = views.journal(spark, folder)
    entries = entries.filter(F.col("_SYSTEMD_UNIT").isin(*views.JOURNAL_UNITS.values()))
    units = {"systemd.containerd.*": "containerd.service", "systemd.kubelet.*": "kubelet.service"}
    records = parse.apply(parse.journal_records(entries), parse.set_constant("unit", units))
    shown = {"time": "time", "log": "log", "process.command": "command",
             "process.command_line": "command_line", "process.pid": "pid",
             "service.name": "service", "unit": "unit"}
    return records.select(
        "record_id", *(string_of(F.col("fields")[k]).alias(n) for k, n in shown.items())
    )


@query(sql(r"""
SELECT '*' AS glob_text, count(*) AS matched FROM logs
UNION ALL SELECT 'kubernetes.*', count(*) FROM logs WHERE starts_with(tag, 'kubernetes.')
UNION ALL SELECT '*_click-*', count(*) FROM logs WHERE contains(tag, '_click-')""", LOGS))
def tag_globs(spark: SparkSession, folder: str) -> DataFrame:
    """Records seen by outputs that match different tag globs, in one pass."""
    globs = ("*", "kubernetes.*", "*_click-*")
    hits = F.array_compact(
        F.array(*(F.when(parse.tag_matches(F.col("tag"), g), F.lit(g)) for g in globs))
    )
    seen = views.raw_logs(spark, folder).select(F.explode(hits).alias("glob_text"))
    return seen.groupBy("glob_text").agg(F.count(F.lit(1)).alias("matched"))


@query(sql(r"""
SELECT record_id, regexp_extract(tag, '@RE@', 1) AS pod_name,
  regexp_extract(tag, '@RE@', 2) AS namespace_name, regexp_extract(tag, '@RE@', 3) AS container_name,
  regexp_extract(tag, '@RE@', 4) AS container_id
FROM logs WHERE regexp_matches(tag, '@RE@')""".replace("@RE@", TAG_RE), LOGS))
def metadata_from_tag(spark: SparkSession, folder: str) -> DataFrame:
    parts = metadata.metadata_from_tag(F.col("tag"), OPTIONS.tag_regex())
    found = views.raw_logs(spark, folder).select("record_id", parts.alias("m"))
    return found.filter("m is not null").select("record_id", "m.*")


LOOSE = r"kubernetes\.var\.log\.containers\.([^_]+)_([^_]+)_(.*)-(.*)\.log"


@query(sql(r"""
SELECT regexp_extract(tag, '@RE@', 2) AS namespace_name, regexp_extract(tag, '@RE@', 3) AS
  container_name, count(*) AS n
FROM logs WHERE regexp_matches(tag, '@RE@') GROUP BY ALL""".replace("@RE@", LOOSE), LOGS))
def metadata_from_loose_tag(spark: SparkSession, folder: str) -> DataFrame:
    parts = metadata.metadata_from_tag(F.col("tag"), metadata.LOOSE_TAG)
    found = views.raw_logs(spark, folder).select(parts.alias("m")).filter("m is not null")
    return found.groupBy("m.namespace_name", "m.container_name").agg(F.count(F.lit(1)).alias("n"))


@query(sql("""
SELECT fallback, drop_without,
  count(*) FILTER (NOT (fallback AND drop_without AND failed)) AS incoming,
  count(*) FILTER (fallback AND failed) AS errors,
  count(*) FILTER (fallback AND drop_without AND failed) AS without_metadata
FROM meta, (VALUES (TRUE, TRUE), (TRUE, FALSE), (FALSE, TRUE), (FALSE, FALSE))
  o(fallback, drop_without)
GROUP BY ALL""", LOGS))
def metadata_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Effect of the fallback and drop options."""
    results = None
    for fallback in (True, False):
        for drop in (True, False):
            options = replace(OPTIONS, fallback_to_tag=fallback, drop_without_metadata=drop)
            rows = metadata.recover_metadata(views.logs(spark, folder), options)
            counted = rows.agg(
                F.count_if(~F.col("lost_metadata")).alias("incoming"),
                F.count_if(F.size("errors") > 0).alias("errors"),
                F.count_if("lost_metadata").alias("without_metadata"),
            ).select(F.lit(fallback).alias("fallback"), F.lit(drop).alias("drop_without"), "*")
            results = counted if results is None else results.unionByName(counted)
    return results


@query(sql("SELECT record_id, host, dynamic, failed FROM hosted", LOGS))
def record_hosts(spark: SparkSession, folder: str) -> DataFrame:
    hosted = routing.with_host(views.logs(spark, folder), OPTIONS)
    return hosted.select("record_id", "host", "dynamic", F.col("lost_metadata").alias("failed"))


@query(sql("SELECT record_id, severity_number, severity_text FROM leveled", LOGS))
def record_severity(spark: SparkSession, folder: str) -> DataFrame:
    s = severity_of(F.col("fields"))
    return views.logs(spark, folder).select("record_id", s.alias("s")).select(
        "record_id", F.col("s.number").alias("severity_number"), F.col("s.text").alias(
            "severity_text")
    )


@query(sql("""
SELECT word, CASE word WHEN 'trace' THEN 1 WHEN 'DBG' THEN 5 WHEN 'INFORMATION' THEN 9
    WHEN 'Warning' THEN 13 WHEN 'err' THEN 17 WHEN 'crit' THEN 21 ELSE 9 END AS severity,
  n_syslog, CASE WHEN n_syslog IN (0, 1) THEN 24 WHEN n_syslog = 2 THEN 21
    WHEN n_syslog = 3 THEN 17 WHEN n_syslog = 4 THEN 13 WHEN n_syslog = 7 THEN 5 ELSE 9 END
    AS severity_syslog, count(*) AS n
FROM (SELECT ['trace', 'DBG', 'INFORMATION', 'Warning', 'err', 'crit', 'Err', 'NOTICE']
        [1 + l_orderkey % 8] AS word, l_linenumber + 1 - l_orderkey % 3 AS n_syslog FROM lineitem)
GROUP BY ALL"""))
def severity_spellings(spark: SparkSession, folder: str) -> DataFrame:
    """Level words and syslog numbers through a JSON record each."""
    words = ["trace", "DBG", "INFORMATION", "Warning", "err", "crit", "Err", "NOTICE"]
    items = views.table(spark, folder, "lineitem").select(
        F.get(F.array(*map(F.lit, words)), (F.col("l_orderkey") % 8).cast("int")).alias("word"),
        (F.col("l_linenumber") + 1 - F.col("l_orderkey") % 3).alias("n_syslog"),
    )
    line = F.to_json(F.struct(F.col("word").alias("lvl")))
    fields = F.col("fields")
    return parse.json_records(items.withColumn("line", line)).groupBy(
        "word", severity_of(fields)["number"].alias("severity"), "n_syslog",
        severity_of_number(F.col("n_syslog")).alias("severity_syslog"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(sql("""
SELECT severity, CASE upper(trim(severity)) WHEN 'F' THEN 'FATAL' WHEN 'N' THEN 'NOTICE'
    WHEN 'W' THEN 'WARN' WHEN 'EROR' THEN 'ERR' WHEN 'INF' THEN 'INFO' WHEN 'DEBUG' THEN 'DBG'
    ELSE severity END AS unified, count(*) AS n
FROM (SELECT CASE l_linenumber WHEN 1 THEN ' w ' WHEN 2 THEN 'Eror' WHEN 3 THEN 'inf'
        WHEN 4 THEN 'debug ' ELSE lower(l_linestatus) || CASE WHEN l_returnflag = 'N' THEN ''
        ELSE ' ' END END AS severity FROM lineitem) GROUP BY ALL"""))
def unified_severity(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("l_linenumber")
    severity = (
        F.when(n == 1, " w ").when(n == 2, "Eror").when(n == 3, "inf").when(n == 4, "debug ")
        .otherwise(F.concat(F.lower("l_linestatus"),
                            F.when(F.col("l_returnflag") == "N", "").otherwise(" ")))
    )
    items = views.table(spark, folder, "lineitem").select(severity.alias("severity"))
    return items.groupBy("severity", unify_severity(F.col("severity")).alias("unified")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(sql("SELECT record_id, CASE WHEN is_empty THEN '{}' ELSE log_text END AS body FROM logs",
           LOGS))
def record_bodies(spark: SparkSession, folder: str) -> DataFrame:
    return views.logs(spark, folder).select("record_id", otel.body_of(F.col("fields")).alias("body"))


@query(sql(r"""
SELECT record_id, bytes > 1024 AS is_cut, bytes,
  CASE WHEN bytes > 1024 THEN '... <truncated ' || (bytes - 1024) || ' bytes>' ELSE '' END AS note,
  sha256(CASE WHEN bytes <= 1024 THEN doc ELSE left(doc, list_max(list_filter(range(250, 1025),
    lambda k: octet_length(encode(left(doc, k))) <= 1024))) END) AS digest
FROM (SELECT *, octet_length(encode(doc)) AS bytes FROM (
  SELECT CAST(doc_id AS VARCHAR) AS record_id,
    replace(replace(replace('{"lang":' || CAST(to_json(lang) AS VARCHAR) || ',"source":'
      || CAST(to_json(source) AS VARCHAR) || ',"text":' || CAST(to_json(text) AS VARCHAR) || '}',
      '<', '\u003c'), '>', '\u003e'), '&', '\u0026') AS doc
  FROM documents))"""))
def long_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Object bodies over 1,024 bytes keep their first bytes and a note of the rest."""
    body = otel.body_of(F.col("fields"))
    records = views.long_logs(spark, folder).select("record_id", body.alias("body"))
    note = F.regexp_extract("body", r"\.\.\. <truncated (\d+) bytes>\z", 0)
    cut = F.regexp_extract("body", r"\.\.\. <truncated (\d+) bytes>\z", 1)
    records = records.withColumns({"note": note, "cut": cut})
    head = F.substr("body", F.lit(1), F.length("body") - F.length("note"))
    whole = F.rtrim(head, F.lit("�"))
    size = F.when(F.col("cut") != "", F.col("cut").try_cast("bigint") + 1024).otherwise(
        F.octet_length("body").cast("bigint")
    )
    return records.select(
        "record_id", (F.col("cut") != "").alias("is_cut"), size.alias("bytes"), "note",
        F.sha2(whole, 256).alias("digest"),
    )


K8S_SQL = """
k8s AS (
  SELECT record_id, unnest([
    {'key': 'k8s.namespace.name', 'v': found},
    {'key': 'k8s.pod.name', 'v': CASE WHEN has_k8s THEN pod ELSE regexp_extract(rtag, '@RE@', 1) END},
    {'key': 'k8s.pod.uid', 'v': CASE WHEN has_k8s THEN pod_id END},
    {'key': 'k8s.container.name', 'v': CASE WHEN has_k8s THEN event_type
                                            ELSE regexp_extract(rtag, '@RE@', 3) END},
    {'key': 'container.id', 'v': CASE WHEN has_k8s THEN digest
                                      ELSE regexp_extract(rtag, '@RE@', 4) END},
    {'key': 'k8s.node.name', 'v': CASE WHEN has_k8s THEN node END}], recursive := true)
  FROM hosted WHERE NOT failed)""".replace("@RE@", TAG_RE)


@query(sql("SELECT record_id, key, v AS value FROM k8s WHERE coalesce(v, '') <> ''", LOGS, K8S_SQL))
def kubernetes_attributes(spark: SparkSession, folder: str) -> DataFrame:
    recovered = metadata.recover_metadata(views.logs(spark, folder), OPTIONS)
    kept = recovered.filter(~F.col("lost_metadata"))
    attributes = otel.k8s_attributes(otel.k8s_metadata(F.col("fields")))
    return kept.select("record_id", F.inline(attributes)).select(
        "record_id", "key", F.col("str_value").alias("value")
    )


@query(sql("""
SELECT key, value_type, count(*) AS n, count(DISTINCT str_value) AS texts,
  CAST(sum(int_value) AS BIGINT) AS ints, round(sum(flt_value), 2) AS floats,
  count(*) FILTER (bool_value) AS trues
FROM (
  SELECT 'brand' AS key, 'string' AS value_type, p_brand AS str_value, NULL::BIGINT AS int_value,
    NULL::DOUBLE AS flt_value, NULL::BOOLEAN AS bool_value FROM part
  UNION ALL SELECT 'size', 'int64', NULL, p_size, NULL, NULL FROM part
  UNION ALL SELECT 'price', 'float64', NULL, NULL, p_retailprice + 0.25, NULL FROM part
  UNION ALL SELECT 'large', 'bool', NULL, NULL, NULL, p_size > 25 FROM part
  UNION ALL SELECT 'dims', 'string', '<map: 2 keys>', NULL, NULL, NULL FROM part
  UNION ALL SELECT 'words', 'string', '<array: '
    || length(string_split(p_name, ' ')) || ' items>', NULL, NULL, NULL FROM part
  UNION ALL SELECT 'none', 'string', '<<nil>>', NULL, NULL, NULL FROM part
  UNION ALL SELECT 'level', 'string', CASE WHEN p_partkey % 4 = 0 THEN 'kind' ELSE 'info' END,
    NULL, NULL, NULL FROM part
  UNION ALL SELECT 'kind', 'string', p_type, NULL, NULL, NULL FROM part WHERE p_partkey % 4 <> 0)
GROUP BY ALL"""))
def typed_attributes(spark: SparkSession, folder: str) -> DataFrame:
    """Every value kind as an attribute; a key that equals the severity text is left out."""
    p = views.table(spark, folder, "part")
    record = F.struct(
        F.col("p_name").alias("message"),
        F.col("p_brand").alias("brand"), F.col("p_size").alias("size"),
        (F.col("p_retailprice") + 0.25).alias("price"),
        (F.col("p_size") > 25).alias("large"), F.struct("p_size", "p_type").alias("dims"),
        F.split("p_name", " ").alias("words"), F.lit(None).cast("string").alias("none"),
        F.when(F.col("p_partkey") % 4 == 0, "kind").otherwise("info").alias("level"),
        F.col("p_type").alias("kind"),
    )
    line = F.to_json(record, {"ignoreNullFields": "false"})
    records = parse.json_records(p.select(line.alias("line")))
    fields = F.col("fields")
    pairs = F.inline(otel.record_attributes(fields, severity_of(fields)["text"]))
    return records.select(pairs).groupBy("key", "value_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("str_value").alias("texts"),
        F.sum("int_value").alias("ints"), F.round(F.sum("flt_value"), 2).alias("floats"),
        F.count_if("bool_value").alias("trues"),
    )


@query(sql("""
SELECT record_id, ts, severity_number, severity_text,
  CASE WHEN is_empty THEN '{}' ELSE log_text END AS body, 'node-a' AS host_name,
  'logloom' AS scope_name, 'https://opentelemetry.io/schemas/1.27.0' AS schema_url,
  (SELECT count(*) FROM k8s k WHERE k.record_id = l.record_id AND coalesce(v, '') <> '')
    + 1 + CASE WHEN is_empty THEN 0 ELSE 3 + CASE WHEN tag IS NULL THEN 0 ELSE 1 END
    + CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END END AS attributes,
  'seed-1' AS origin, CASE WHEN is_empty THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_text
FROM leveled l WHERE NOT failed""", LOGS, K8S_SQL))
def otel_records(spark: SparkSession, folder: str) -> DataFrame:
    """Complete log records of all kept input records."""
    options = replace(OPTIONS, origin="seed-1", host_name="node-a")
    kept = metadata.recover_metadata(views.logs(spark, folder), options).filter(
        ~F.col("lost_metadata")
    )
    records = otel.to_otel(kept, options)
    return records.select(
        "record_id", "ts", "severity_number", "severity_text", "body",
        F.col("resource")["host.name"].alias("host_name"), F.col("scope.name").alias("scope_name"),
        F.col("scope.schema_url").alias("schema_url"),
        F.size("attributes").cast("bigint").alias("attributes"),
        otel.attribute_text(F.col("attributes"), "origin").alias("origin"),
        otel.attribute_text(F.col("attributes"), "user").alias("user_text"),
    )


@query(sql("""
SELECT CAST(s_suppkey AS VARCHAR) AS name,
  'collector.' || lower(s_name) || '.svc.cluster.local:4317' AS endpoint,
  'http://xxxxx@' || lower(s_name) || '/api?mail=a' AS redacted
FROM supplier"""))
def endpoints(spark: SparkSession, folder: str) -> DataFrame:
    """Endpoint of a name, and an address with its credentials hidden."""
    from logloom.operators.clusters import endpoint_of

    name = F.lower("s_name")
    address = F.concat(F.lit("http://user:p@ss@"), name, F.lit("/api?mail=a"))
    return views.table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("name"),
        endpoint_of(name, OPTIONS).alias("endpoint"), redact_credentials(address).alias("redacted"),
    )


@query(sql("""
SELECT given, CASE upper(given) WHEN 'OTLPGRPC' THEN 'otlp_grpc' WHEN 'OTLP_HTTP' THEN 'otlp_http'
    WHEN 'STDOUT' THEN 'stdout' ELSE 'noop' END AS client,
  CASE upper(given) WHEN 'SEED' THEN 'SEED' WHEN 'SHOOT' THEN 'SHOOT' ELSE 'UNKNOWN' END AS target,
  count(*) AS n
FROM (SELECT ['OtlpGrpc', 'otlp_http', 'StdOut', 'noop', 'seed', 'Shoot'][1 + p_partkey % 6]
      AS given FROM part) GROUP BY ALL"""))
def client_types(spark: SparkSession, folder: str) -> DataFrame:
    names = ["OtlpGrpc", "otlp_http", "StdOut", "noop", "seed", "Shoot"]
    given = F.get(F.array(*map(F.lit, names)), (F.col("p_partkey") % 6).cast("int"))
    parts = views.table(spark, folder, "part").select(given.alias("given"))
    return parts.groupBy(
        "given", routing.client_type(F.col("given")).alias("client"),
        routing.target_of(F.col("given")).alias("target"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(sql("""
SELECT record_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp, log_text AS log,
  CASE WHEN has_k8s THEN pod WHEN NOT failed THEN regexp_extract(rtag, 'TAGRE', 1) END AS pod
FROM hosted WHERE NOT is_empty""".replace("TAGRE", TAG_RE), LOGS))
def stdout_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the stdout sink with recovered metadata, read back as JSON."""
    from logloom.operators.metadata import recover_metadata
    from logloom.sources.sinks import stdout_lines as to_lines

    lines = to_lines(recover_metadata(views.logs(spark, folder), RouteOptions()), "record_id")
    # each line is written once and parsed once
    parsed = once(once(lines, value=F.col("value")), parsed=F.try_parse_json("value"))
    found = once(
        parsed, timestamp=F.try_variant_get("parsed", "$.timestamp", "string"),
        log=F.try_variant_get("parsed", "$.record.log", "string"),
        pod=F.try_variant_get("parsed", "$.record.kubernetes.pod_name", "string"))
    return found.select("record_id", "timestamp", "log", "pod").filter("log is not null")


@query(sql("""
SELECT record_id, severity_text, user_id AS user_number, value AS value_number
FROM leveled WHERE NOT failed AND NOT is_empty""", LOGS))
def packed_records(spark: SparkSession, folder: str) -> DataFrame:
    """Log records written as JSON lines and read back with typed attributes."""
    kept = metadata.recover_metadata(views.logs(spark, folder), OPTIONS).filter(
        ~F.col("lost_metadata")
    )
    records = otel.to_otel(kept, OPTIONS)
    back = otel.unpack(otel.pack(records), records.schema)

    def found(key):
        return F.get(F.filter("attributes", lambda a: a["key"] == key), F.lit(0))

    values = once(back.select("record_id", "severity_text", "attributes"), user=found("user"), value=found("value"))
    return values.select(
        "record_id", "severity_text", F.col("user")["int_value"].alias("user_number"),
        F.col("value")["flt_value"].alias("value_number"),
    ).filter("user_number is not null")
