"""Records to OpenTelemetry log records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.once import let, once
from logloom.functions.severity import severity_of
from logloom.functions.values import (
    BODY_LIMIT,
    cut_bytes,
    html_safe,
    is_number,
    kind,
    string_of,
    text,
)
from logloom.options import RouteOptions

# Metadata key -> semantic attribute, and keys that are never attributes.
K8S_ATTRIBUTES = {
    "namespace_name": "k8s.namespace.name",
    "pod_name": "k8s.pod.name",
    "pod_id": "k8s.pod.uid",
    "container_name": "k8s.container.name",
    "container_id": "container.id",
    "host": "k8s.node.name",
}
BODY_KEYS = ("log", "message")
SKIPPED_KEYS = ("log", "message", "kubernetes")

ATTRIBUTE = {
    "key": "string", "value_type": "string", "str_value": "string", "int_value": "bigint",
    "flt_value": "double", "bool_value": "boolean", "byte_value": "binary",
}


def body_of(fields: Column) -> Column:
    """`log`, then `message`: text whole, objects as JSON cut by bytes; else the record."""
    sources = []
    for key in BODY_KEYS:
        value = fields[key]
        as_json = cut_bytes(html_safe(F.to_json(value)))
        sources.append(
            F.when(kind(value) == "STRING", text(value)).when(
                kind(value).startswith("OBJECT"), as_json
            )
        )
    return F.coalesce(*sources, html_safe(F.to_json(fields)))


def empty_values() -> dict[str, Column]:
    """The NULL of every attribute field; share it between attributes of one expression."""
    return {n: F.lit(None).cast(t).alias(n) for n, t in ATTRIBUTE.items()}


def attribute(empty: dict[str, Column], **values: Column) -> Column:
    """One typed key/value pair; fields not given are NULL."""
    return F.struct(*(values[n].alias(n) if n in values else c for n, c in empty.items()))


def _typed(key: Column, value: Column, value_kind: Column) -> Column:
    """Scalars keep their type; containers become a short note of their size."""

    empty = empty_values()

    def pair(value_type: str, **typed: Column) -> Column:
        return attribute(empty, key=key, value_type=F.lit(value_type), **typed)

    def note(kind_name: str, schema: str, unit: str) -> Column:
        size = F.size(F.try_variant_get(value, "$", schema))
        return pair("string", str_value=F.concat(F.lit(f"<{kind_name}: "), size, F.lit(unit)))

    return (
        F.when(value_kind == "STRING", pair("string", str_value=text(value)))
        .when(value_kind == "BIGINT",
              pair("int64", int_value=F.try_variant_get(value, "$", "bigint")))
        .when(is_number(value_kind),
              pair("float64", flt_value=F.try_variant_get(value, "$", "double")))
        .when(value_kind == "BOOLEAN",
              pair("bool", bool_value=F.try_variant_get(value, "$", "boolean")))
        .when(value_kind.startswith("OBJECT"), note("map", "map<string,variant>", " keys>"))
        .when(value_kind.startswith("ARRAY"), note("array", "array<variant>", " items>"))
        .when(value_kind == "VOID", pair("string", str_value=F.lit("<<nil>>")))
        .otherwise(pair("string", str_value=text(value)))
    )


def record_attributes(fields: Column, severity_text: Column) -> Column:
    """All other record fields in the order of the record (by key, when it was parsed from
    JSON); a key that equals the severity text is left out."""
    kept = F.filter(
        F.map_entries(fields),
        lambda e: ~e["key"].isin(*SKIPPED_KEYS) & (e["key"] != severity_text),
    )
    return F.transform(
        kept, lambda e: let(kind(e["value"]), lambda k: _typed(e["key"], e["value"], k))
    )


def k8s_metadata(fields: Column) -> Column:
    """STRUCT of the six metadata strings of a record."""
    in_record = F.try_variant_get(fields["kubernetes"], "$", "map<string,variant>")

    def strings(own: Column) -> Column:
        return F.struct(*(string_of(own[n]).alias(n) for n in K8S_ATTRIBUTES))

    return let(in_record, strings)


def k8s_attributes(k8s: Column) -> Column:
    """The non-empty metadata strings as attributes, in fixed order."""

    def listed(found: Column) -> Column:
        empty, string = empty_values(), F.lit("string")
        every = (
            F.when(found[n] != "", attribute(empty, key=F.lit(name), value_type=string,
                                             str_value=found[n]))
            for n, name in K8S_ATTRIBUTES.items()
        )
        return F.array_compact(F.array(*every))

    return let(k8s, listed)


def to_otel(df: DataFrame, options: RouteOptions) -> DataFrame:
    """Replace `fields` and the metadata columns by the columns of a log record."""
    fields = F.col("fields")
    df = once(df, _severity=severity_of(fields))
    severity = F.col("_severity")
    attributes = [k8s_attributes(k8s_metadata(fields))]
    if options.origin:
        origin = {"key": "origin", "value_type": "string", "str_value": options.origin}
        values = {n: F.lit(v) for n, v in origin.items()}
        attributes.append(F.array(attribute(empty_values(), **values)))
    attributes.append(record_attributes(fields, severity["text"]))
    resource = {"host.name": options.host_name} if options.host_name else {}
    made = {
        "observed_ts": F.col("ts"),
        "severity_number": severity["number"],
        "severity_text": severity["text"],
        "body": body_of(fields),
        "attributes": F.concat(*attributes),
        "resource": F.create_map(*(F.lit(x) for kv in resource.items() for x in kv)).cast(
            "map<string,string>"
        ),
        "scope": F.struct(
            F.lit(options.scope_name).alias("name"),
            F.lit(options.scope_version).alias("version"),
            F.lit(options.scope_schema_url).alias("schema_url"),
        ),
        "trace_id": F.lit(None).cast("binary"),
        "span_id": F.lit(None).cast("binary"),
        "trace_flags": F.lit(0).cast("tinyint"),
    }
    return df.withColumns(made).drop("_severity", "fields")


def attribute_text(attributes: Column, key: str) -> Column:
    """Text of the first attribute with this key, NULL if there is none."""
    found = F.get(F.filter(attributes, lambda a: a["key"] == key), F.lit(0))
    return F.coalesce(
        found["str_value"], found["int_value"].cast("string"), found["flt_value"].cast("string"),
        found["bool_value"].cast("string"),
    )


def pack(df: DataFrame) -> DataFrame:
    """One JSON line per log record (`value STRING`), lossless for typed attributes."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def unpack(lines: DataFrame, schema) -> DataFrame:
    """Read packed lines back; attributes of type `other` are not restored."""
    df = once(lines, r=F.from_json("value", schema)).select("r.*")
    restored = F.filter("attributes", lambda a: a["value_type"] != "other")
    return once(df, attributes=restored).select(*df.columns)


__all__ = [
    "BODY_LIMIT", "attribute", "attribute_text", "body_of", "k8s_attributes", "k8s_metadata",
    "pack", "record_attributes", "to_otel", "unpack",
]
