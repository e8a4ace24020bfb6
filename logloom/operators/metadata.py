"""Kubernetes metadata of a record: own, else recovered from its tag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.once import let, once
from logloom.functions.patterns import java_regex
from logloom.functions.values import string_of
from logloom.options import RouteOptions

TAG_PARTS = ("pod_name", "namespace_name", "container_name", "container_id")

# Fixed value: loose tag layout without a rule for the container id.
LOOSE_TAG = r"kubernetes\.var\.log\.containers\.([^_]+)_([^_]+)_(.*)-(.*)\.log"

# Error and reason names.
TAG_ERROR = "CanNotExtractMetadataFromTag"
NO_METADATA = "dropped_no_metadata"


def metadata_from_tag(tag: Column, pattern: str) -> Column:
    """STRUCT of the four tag parts, NULL if the tag is missing or of another form.

    One regex pass: a matching tag is rewritten to its parts around a separator that no tag
    contains, any other tag is left whole.
    """
    return let(tag_parts(tag, pattern), named_parts)


def tag_parts(tag: Column, pattern: str) -> Column:
    whole = r"\A(?s:.*?)" + java_regex(pattern) + r"(?s:.*)\z"
    return F.split(F.regexp_replace(tag, whole, "$1\u0001$2\u0001$3\u0001$4"), "\u0001")


def named_parts(parts: Column) -> Column:
    fields = [parts[i].alias(n) for i, n in enumerate(TAG_PARTS)]
    return F.when(F.size(parts) == len(TAG_PARTS), F.struct(*fields))


def recover_metadata(df: DataFrame, options: RouteOptions) -> DataFrame:
    """Put metadata from the tag into `fields`; add `errors` and `lost_metadata`.

    The tag is read only where `kubernetes` is absent and the fallback is on; a record whose
    tag fails is an error, and lost if the options say so. Keys stay in order.
    """
    return put_metadata(find_metadata(df, options))


def find_metadata(df: DataFrame, options: RouteOptions) -> DataFrame:
    """Add `errors`, `lost_metadata` and `_found`, the metadata that `fields` lacks and the tag has."""
    fields = F.col("fields")
    absent = ~F.coalesce(F.map_contains_key(fields, F.lit("kubernetes")), F.lit(False))
    needed = absent & F.lit(options.fallback_to_tag)
    tag = string_of(fields[options.tag_key])
    # the parts are columns of their own: a lambda would keep all this from compiled code
    df = once(df, _needed=needed, _parts=F.when(needed, tag_parts(tag, options.tag_regex())))
    df = df.withColumn("_found", named_parts(F.col("_parts")))
    failed = F.col("_needed") & F.col("_found").isNull()
    return df.withColumns(
        {
            "errors": F.when(failed, F.array(F.lit(TAG_ERROR))).otherwise(
                F.array().cast("array<string>")
            ),
            "lost_metadata": failed & F.lit(options.drop_without_metadata),
        }
    ).drop("_needed", "_parts")


def put_metadata(df: DataFrame) -> DataFrame:
    """Put what `find_metadata` found into `fields`."""
    fields = F.col("fields")
    with_found = F.map_concat(
        F.map_filter(fields, lambda k, _: k < "kubernetes"),
        F.create_map(F.lit("kubernetes"), F.to_variant_object("_found")),
        F.map_filter(fields, lambda k, _: k > "kubernetes"),
    )
    fields = F.when(F.col("_found").isNull(), fields).otherwise(with_found)
    own = [c for c in df.columns if c not in ("fields", "errors", "lost_metadata", "_found")]
    return once(df, fields=fields).select(
        *(F.col(f"`{c}`") for c in own), "fields", "errors", "lost_metadata")
