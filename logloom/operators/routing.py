"""Where each record goes: host, destination, disposition, fan-out.

`ledger` gives every record exactly one disposition; all counters are aggregates over it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.patterns import matches
from logloom.functions.values import text
from logloom.operators.clusters import by_slice
from logloom.operators.lookup import fits_broadcast, lookup_join
from logloom.operators.metadata import NO_METADATA, TAG_PARTS, find_metadata, put_metadata
from logloom.operators.slices import DAY, running, slice_of
from logloom.options import SEED_HOST, RouteOptions
from logloom.session import settle

# Client types by accepted spelling, and delivery targets.
CLIENT_TYPES = {
    "OTLPGRPC": "otlp_grpc",
    "OTLP_GRPC": "otlp_grpc",
    "OTLPHTTP": "otlp_http",
    "OTLP_HTTP": "otlp_http",
    "STDOUT": "stdout",
    "NOOP": "noop",
}
TARGETS = ("SEED", "SHOOT")

DESTINATION = "struct<target:string,endpoint:string,client:string>"


def client_type(name: Column | str) -> Column:
    """Known client type; any other name means noop."""
    table = F.create_map(*(F.lit(x) for kv in CLIENT_TYPES.items() for x in kv))
    name = F.lit(name) if isinstance(name, str) else name
    return F.coalesce(table[F.upper(name)], F.lit("noop"))


def target_of(name: Column) -> Column:
    return F.when(F.upper(name).isin(*TARGETS), F.upper(name)).otherwise("UNKNOWN")


def dynamic_host(fields: Column, options: RouteOptions) -> Column:
    """Value at the configured path, '' when any step is missing."""
    if not options.host_path:
        return F.lit("")
    head, *rest = options.host_path
    steps = "$" + "".join("['" + s.replace("\\", "\\\\").replace("'", "\\'") + "']" for s in rest)
    own = text(F.try_variant_get(fields[head], steps, "variant")) if rest else text(
        fields[head]
    )
    return F.coalesce(own, F.lit(""))


def is_dynamic(host: Column, options: RouteOptions) -> Column:
    if options.host_regex is None:
        return F.lit(False)
    return (host != "") & matches(host, options.host_regex)


def with_host(df: DataFrame, options: RouteOptions, whole: bool = True) -> DataFrame:
    """Metadata recovery, then `host` (label) and `dynamic`.

    Unless `whole`, metadata found in the tag stays in `_found`: putting it into the map of fields
    costs more than all the rest.
    """
    df = find_metadata(df, options)
    head, *rest = options.host_path or ("",)
    apart = not whole and (head != "kubernetes" or len(rest) == 1)
    if not apart:
        df = put_metadata(df)
    own = dynamic_host(F.col("fields"), options)
    if apart and head == "kubernetes":
        name = F.col("_found")[rest[0]] if rest[0] in TAG_PARTS else F.lit("")
        own = F.when(F.col("_found").isNotNull(), name).otherwise(own)
    df = df.withColumn("_host", own).withColumn("dynamic", is_dynamic(F.col("_host"), options))
    return df.withColumn("host", F.when(F.col("dynamic"), F.col("_host")).otherwise(SEED_HOST)).drop(
        "_host"
    )


def _decide(df: DataFrame, options: RouteOptions) -> DataFrame:
    """`disposition` and `destinations` from the looked-up route columns."""
    empty = F.size("fields") == 0
    if "_found" in df.columns:
        empty = empty & F.col("_found").isNull()
    routed = F.col("endpoint").isNotNull()
    to_seed_only = ~F.col("dynamic") | F.lit(not options.controller_present)
    seed = F.struct(
        F.lit("SEED").alias("target"),
        F.lit(options.seed_endpoint).alias("endpoint"),
        client_type(options.seed_type).alias("client"),
    )
    shoot = F.struct(
        F.lit("SHOOT").alias("target"),
        F.col("endpoint").alias("endpoint"),
        client_type(options.shoot_type).alias("client"),
    )
    disposition = (
        F.when(F.col("lost_metadata"), NO_METADATA)
        .when(empty, "dropped_empty")
        .when(to_seed_only, "routed")
        .when(~routed, "dropped_no_client")
        .when(~F.col("to_shoot") & ~F.col("to_seed"), "muted")
        .otherwise("routed")
    )
    df = df.withColumn("disposition", disposition)
    none = F.array().cast(f"array<{DESTINATION}>")
    chosen = (
        F.when(to_seed_only, F.array(seed))
        .when(F.col("to_shoot") & F.col("to_seed"), F.array(shoot, seed))
        .when(F.col("to_shoot"), F.array(shoot))
        .when(F.col("to_seed"), F.array(seed))
        .otherwise(none)
    )
    return df.withColumn(
        "destinations", F.when(F.col("disposition") == "routed", chosen).otherwise(none)
    ).drop("lost_metadata", "dynamic", "state", "to_shoot", "to_seed", "endpoint", "_found")


ROUTE = ("to_shoot", "to_seed", "endpoint")
KEY = "_route_key"


def keyed(df: DataFrame) -> DataFrame:
    """Add the key by which a record meets its route: its host if that is dynamic.

    All other records carry the seed's host; they need no route, and a key of their own keeps
    them from gathering in the tasks of one host.
    """
    alone = F.concat(F.lit("\u0001"), F.coalesce(F.col("record_id").cast("string"), F.lit("")))
    return df.withColumn(KEY, F.when(F.col("dynamic"), F.col("host")).otherwise(alone))


def ledger(
    records: DataFrame, routes: DataFrame | None, options: RouteOptions, settled: bool = False,
    whole: bool = True,
) -> DataFrame:
    """One row per record with `host`, `errors`, `disposition` and `destinations`.

    `routes` holds the live routes (one row per host); records keep their partitioning. Unless
    `whole`, their `fields` are left out: what only counts or names records needs no rebuilt ones.
    """
    df = with_host(records, options, whole)
    if routes is None:
        df = df.withColumns({
            "to_shoot": F.lit(None).cast("boolean"), "to_seed": F.lit(None).cast("boolean"),
            "endpoint": F.lit(None).cast("string"),
        })
    else:
        table = routes.select(F.col("host").alias(KEY), *ROUTE)
        df = lookup_join(keyed(df), table, [KEY], spread="record_id", settled=settled).drop(KEY)
    decided = _decide(df, options)
    return decided if whole else decided.drop("fields")


def ledger_as_of(
    records: DataFrame, history: DataFrame, options: RouteOptions, width: int = DAY,
    max_per_slice: int = 256,
) -> DataFrame:
    """Like `ledger`, with the route that was live at the time of each record.

    A history that is small and has few changes per host and slice is broadcast. Otherwise
    records and changes are ordered together, in slices.
    """
    history = settle(history.select("host", "valid_from", "valid_to", *ROUTE))
    intervals = by_slice(history.filter("valid_to is not null"), width)
    densest = intervals.groupBy("host", "_slice").count().agg(F.max("count")).first()[0] or 0
    df = keyed(with_host(records, options))
    history, intervals = (t.withColumnRenamed("host", KEY) for t in (history, intervals))
    if densest <= max_per_slice and fits_broadcast(intervals):
        found = _by_lookup(df, history, intervals, width)
    else:
        found = _by_order(df, history, width)
    return _decide(found.drop(KEY), options)


def _by_lookup(
    df: DataFrame, history: DataFrame, intervals: DataFrame, width: int
) -> DataFrame:
    """The open interval of a host by host, closed ones by host and slice."""
    still_open = history.filter("valid_to is null").select(
        KEY, F.struct(F.col("valid_from").alias("since"), *ROUTE).alias("now")
    )
    df = lookup_join(df, still_open, [KEY], spread="record_id", settled=True)
    df = df.withColumn("_slice", slice_of(F.col("ts"), width))
    inside = (F.col("ts") >= F.col("valid_from")) & (F.col("ts") < F.col("valid_to"))
    df = lookup_join(
        df, intervals, [KEY, "_slice"], condition=inside, spread="record_id", settled=True
    )
    is_open = F.coalesce(F.col("ts") >= F.col("now.since"), F.lit(False))
    picked = {c: F.when(is_open, F.col("now")[c]).otherwise(F.col(c)) for c in ROUTE}
    return df.withColumns(picked).drop("_slice", "valid_from", "valid_to", "now")


def _by_order(df: DataFrame, history: DataFrame, width: int) -> DataFrame:
    """Route of the last change before each record, by a running maximum over both."""
    nothing = F.struct(*(F.lit(None).cast(history.schema[c].dataType).alias(c) for c in ROUTE))

    def change(ts: str, kind: int, route: Column) -> DataFrame:
        rows = history.filter(F.col(ts).isNotNull())
        return rows.select(KEY, F.col(ts).alias("ts"), F.lit(kind).alias("kind"),
                           route.alias("route"))

    changes = change("valid_to", 0, nothing).unionByName(
        change("valid_from", 1, F.struct(*ROUTE))
    )
    mixed = df.select(KEY, "ts", F.lit(2).alias("kind"), F.struct("*").alias("row")).unionByName(
        changes, allowMissingColumns=True
    )
    change_at = F.when(F.col("kind") < 2, F.struct("ts", "kind", "route"))
    last = running(mixed, [KEY], ["ts", "kind"], {"last": ("max", change_at)}, width)
    return last.filter("kind = 2").select("row.*", "last.route.*")


def fan_out(ledger_rows: DataFrame) -> DataFrame:
    """One row per routed record and destination."""
    return ledger_rows.select(
        *(c for c in ledger_rows.columns if c != "destinations"),
        F.inline("destinations"),
    )
