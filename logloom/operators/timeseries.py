"""Metric samples: rates, deltas, quantiles, alert rules, service levels.

A sample frame has `series STRING, ts, value DOUBLE` and any label columns; `series` names one
label set. Windows are sliced in time, so one busy series is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions.once import let
from logloom.functions.values import micros
from logloom.operators.slices import HOUR, measured, neighbour, running

# Thresholds and service level targets.
WARNING = {"queue_size": 400.0, "export_latency": 5.0, "error_rate": 0.01}
CRITICAL = {"export_latency": 10.0, "error_rate": 0.1, "logs_dropped": 0.0}
AVAILABILITY_TARGET = 0.999
ERROR_RATIO_TARGET = 0.001
LATENCY_TARGET = 5.0
SLO_DAYS = 30
# Alert -> (kind, range in seconds, comparison, bound, held for seconds, severity).
ALERTS = {
    "QueueGrowing": ("delta", 300, ">", 100.0, 600, "warning"),
    "QueueNearCapacity": ("per_client", 0, ">", 400.0, 300, "warning"),
    "LogsDropped": ("rate", 300, ">", 0.0, 60, "critical"),
    "HighErrorRate": ("rate", 300, ">", 0.1, 300, "warning"),
    "HighExportLatency": ("p95", 300, ">", 10.0, 300, "warning"),
    "PluginUnhealthy": ("value", 0, "==", 0.0, 120, "critical"),
    "NoLogsSent": ("rate", 300, "==", 0.0, 600, "warning"),
}


def series_key(labels: Column) -> Column:
    """One text per label set, whatever the order of its entries."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(labels))))


def _grown(value: Column, before: Column) -> Column:
    """Increase since the sample before; after a reset that is the new value."""
    return F.when(value < before, value).otherwise(value - before)


def increases(df: DataFrame, width: int = HOUR) -> DataFrame:
    """Add `increase` since the previous sample."""
    df = neighbour(df, ["series"], ["ts"], {"value": "_previous"}, width=width)
    return df.withColumn("increase", _grown(F.col("value"), F.col("_previous"))).drop("_previous")


def _met(df: DataFrame, sample_at: Column, marker_at: Column, inclusive: bool, value: Column,
         name: str, width: int) -> DataFrame:
    """Add `name`: `value` of the last sample before (or at) each row's marker on the same axis.

    Samples and markers are ordered together once, so the cost does not depend on how many
    samples a window holds.
    """
    sample, marker = (0, 1) if inclusive else (1, 0)
    samples = df.select("series", F.timestamp_micros(sample_at).alias("_at"),
                        F.lit(sample).alias("_kind"), value.alias("_value"))
    markers = df.select("series", F.timestamp_micros(marker_at).alias("_at"),
                        F.lit(marker).alias("_kind"), F.struct("*").alias("_row"))
    seen = F.when(F.col("_kind") == sample, F.struct("_at", "_value"))
    last = running(samples.unionByName(markers, allowMissingColumns=True), ["series"],
                   ["_at", "_kind"], {"_last": ("max", seen)}, width)
    return last.filter(F.col("_kind") == marker).select(
        "_row.*", F.col("_last._value").alias(name))


def rates(df: DataFrame, columns: dict[str, str], seconds: int, width: int = HOUR) -> DataFrame:
    """Add per-second rates of several counters over the last `seconds` at every sample.

    `columns` maps a counter to the name of its rate. The increase within a window is the
    difference of its running sums at both ends (no extrapolation). If every series fits one
    window group, lag and both sums come from one sort; their frames begin with the series, so
    the cost does not depend on how many samples a window holds.
    """
    df, small = measured(df, ["series"])
    at, span = micros(F.col("ts")), seconds * 1_000_000
    grown = {f"_sum_{c}": F.coalesce(_grown(F.col(c), F.col(f"_was_{c}")), F.lit(0.0)) for c in columns}
    if small:
        order = Window.partitionBy("series").orderBy("_at")
        lagged = df.withColumn("_at", at).withColumns({f"_was_{c}": F.lag(c).over(order) for c in columns})
        upto = order.rangeBetween(Window.unboundedPreceding, 0)
        before = order.rangeBetween(Window.unboundedPreceding, -span - 1)
        found = {name: (F.sum(f"_sum_{c}").over(upto) - F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0.0)))
                 / seconds for c, name in columns.items()}
        return lagged.withColumns(grown).select(*df.columns, *(v.alias(n) for n, v in found.items()))
    lagged = neighbour(df, ["series"], ["ts"], {c: f"_was_{c}" for c in columns}, width=width)
    counted = running(lagged, ["series"], ["ts"], {n: ("sum", g) for n, g in grown.items()}, width)
    both = _met(counted, at, at - span, False, F.struct(*grown), "_before", width)
    found = {name: (F.col(f"_sum_{c}") - F.coalesce(F.col("_before")[f"_sum_{c}"], F.lit(0.0))) / seconds
             for c, name in columns.items()}
    return both.select(*df.columns, *(v.alias(n) for n, v in found.items()))


def rate(df: DataFrame, seconds: int, width: int = HOUR) -> DataFrame:
    """Add per-second `rate` of `value` over the last `seconds` at every sample."""
    return rates(df, {"value": "rate"}, seconds, width)


def delta(df: DataFrame, seconds: int, width: int = HOUR) -> DataFrame:
    """Add `delta`: the value less the oldest one of the last `seconds`.

    The oldest value is the last one at or before the window's start with time turned round.
    """
    df, small = measured(df, ["series"])
    back, span = -micros(F.col("ts")), seconds * 1_000_000
    if small:
        seen = Window.partitionBy("series").orderBy("_at").rangeBetween(Window.unboundedPreceding, span)
        oldest = F.last("value").over(seen)
        return df.withColumn("_at", back).select(*df.columns, (F.col("value") - oldest).alias("delta"))
    both = _met(df, back, back + span, True, F.col("value"), "_oldest", width)
    return both.withColumn("delta", F.expr("value - _oldest")).drop("_oldest")


def rate_sum(rated: DataFrame, *by: str) -> DataFrame:
    """`sum by (...)` of rates at each moment."""
    return rated.groupBy("ts", *by).agg(F.sum("rate").alias("rate"))


def histogram_quantile(buckets: DataFrame, q: float, keys: list[str], value: str) -> DataFrame:
    """Quantile from cumulative buckets: rows (keys, `le DOUBLE`, `value`), one group per key.

    Linear inside a bucket; in the infinite bucket the highest finite bound; NULL if empty.
    A group holds one row per bucket bound, so it is small by nature.
    """
    group = Window.partitionBy(*keys)
    by_bound = group.orderBy("le")
    ranked = buckets.select(
        *keys, "le", F.col(value).alias("_upto"),
        F.coalesce(F.lag(value).over(by_bound), F.lit(0.0)).alias("_below"),
        F.lag("le").over(by_bound).alias("_floor"),
        (F.max(value).over(group) * q).alias("_rank"),
        F.max(value).over(group).alias("_total"),
    )
    low = F.coalesce("_floor", F.when(F.col("le") > 0, F.lit(0.0)).otherwise(F.col("le")))
    inside = low + (F.col("le") - low) * F.try_divide(
        F.col("_rank") - F.col("_below"), F.col("_upto") - F.col("_below")
    )
    point = F.when(F.col("le") == float("inf"), F.col("_floor")).otherwise(
        F.coalesce(inside, F.col("le"))
    )
    hits = ranked.withColumn("_hit", F.expr("_total > 0 and _upto >= _rank"))
    return hits.groupBy(*keys).agg(
        F.min_by(F.when(F.col("_hit"), point), F.when(F.col("_hit"), F.col("le"))).alias("quantile")
    )


def bucket_quantiles(counts: Column, les: Column, qs: tuple[float, ...]) -> Column:
    """Quantiles of one histogram: arrays of cumulative counts and of their bounds, ascending.

    A count below its predecessor (a bucket reset or scraped apart) is raised to it. Linear inside
    a bucket; in the infinite bucket the highest finite bound; NULL if the histogram is empty.
    """
    start = F.array().cast("array<double>")
    steady = F.aggregate(counts, start, lambda done, x: F.array_append(done, F.greatest(
        x, F.coalesce(F.get(done, F.size(done) - 1), F.lit(0.0)))))

    def quantile(found: Column, q: float) -> Column:
        total = F.get(found, F.size(found) - 1)
        rank = total * q
        at = F.get(F.filter(F.sequence(F.lit(0), F.size(found) - 1), lambda i: F.get(found, i) >= rank), F.lit(0))
        bound, floor = F.get(les, at), F.get(les, at - 1)
        low = F.coalesce(floor, F.when(bound > 0, F.lit(0.0)).otherwise(bound))
        below = F.coalesce(F.get(found, at - 1), F.lit(0.0))
        inside = low + (bound - low) * F.try_divide(rank - below, F.get(found, at) - below)
        point = F.when(bound == float("inf"), floor).otherwise(F.coalesce(inside, bound))
        return F.when(total > 0, point)

    return let(steady, lambda found: F.array(*(quantile(found, q) for q in qs)))


def histogram_quantiles(buckets: DataFrame, qs: tuple[float, ...], keys: list[str], value: str) -> DataFrame:
    """`keys`, `q`, `quantile` for all `qs` at once, from cumulative buckets (keys, `le`, `value`)."""
    rows = F.array_sort(F.collect_list(F.struct("le", F.col(value).alias("n"))))
    listed = buckets.groupBy(*keys).agg(rows.alias("_rows"))
    found = bucket_quantiles(F.transform("_rows", lambda r: r["n"]), F.transform("_rows", lambda r: r["le"]), qs)
    return listed.select(*keys, F.inline(F.arrays_zip(F.lit(list(qs)), found))).toDF(*keys, "q", "quantile").filter(
        "quantile IS NOT NULL")


def rate_quantiles(
    histograms: DataFrame, bounds: tuple[float, ...], seconds: int, qs: tuple[float, ...], width: int = HOUR
) -> DataFrame:
    """`series, ts, q, quantile`: `histogram_quantile(q, rate(bucket[seconds]))` for all `qs` at once.

    `histograms` has one row per series and moment with the cumulative counters `buckets`, an array
    by bound. Each bucket has its own resets; all share one order of the series.
    """
    names = {f"_b{i}": f"_r{i}" for i in range(len(bounds))}
    spread = histograms.select("series", "ts", *(
        F.get("buckets", F.lit(i)).alias(c) for i, c in enumerate(names)))
    rated = rates(spread, names, seconds, width)
    found = bucket_quantiles(F.array(*names.values()), F.lit([float(b) for b in bounds]), qs)
    return rated.select("series", "ts", F.inline(F.arrays_zip(F.lit(list(qs)), found))).toDF(
        "series", "ts", "q", "quantile")


def held(
    df: DataFrame, condition: Column, seconds: int | Column, width: int = HOUR
) -> DataFrame:
    """Add `active` (condition), `active_since` and `firing`: true without a break for at
    least `seconds` at this sample."""
    df = df.withColumn("active", F.coalesce(condition, F.lit(False)))
    df, small = measured(df, ["series"])
    begins = F.col("active") & ~F.coalesce("_before", F.lit(False))
    if small:
        order = Window.partitionBy("series").orderBy("ts")
        start = F.max(F.when(begins, F.col("ts"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
        df = df.withColumn("_before", F.lag("active").over(order)).withColumn("_start", start)
    else:
        df = neighbour(df, ["series"], ["ts"], {"active": "_before"}, width=width)
        df = running(
            df, ["series"], ["ts"], {"_start": ("max", F.when(begins, F.col("ts")))}, width
        )
    since = F.when(F.col("active"), F.col("_start"))
    long_enough = micros(F.col("ts")) - micros(since) >= seconds * 1_000_000
    return df.withColumns(
        {"active_since": since, "firing": F.coalesce(long_enough, F.lit(False))}
    ).drop("_before", "_start")


def condition(df: DataFrame, name: str, seconds: int | None = None) -> DataFrame:
    """A shipped rule's condition at every sample: `alert, severity, hold, series, ts, active`.

    `df` has the samples that the rule's kind needs in `value`: counters for a rate, gauges for a
    delta, and for the other kinds what is compared. Rates and deltas are taken over the rule's
    range, or over `seconds`; a frame that has the column `rate` or `delta` already is not asked.
    """
    kind, span, comparison, bound, hold, severity = ALERTS[name]
    column = F.col("value")
    if kind in ("rate", "delta"):
        if kind not in df.columns:
            df = (rate if kind == "rate" else delta)(df, seconds or span)
        column = F.col(kind)
    active = column > bound if comparison == ">" else column == bound
    return df.select(F.lit(name).alias("alert"), F.lit(severity).alias("severity"),
                     F.lit(hold).alias("hold"), "series", "ts", active.alias("active"))


def unhealthy(up: DataFrame, probe: DataFrame) -> DataFrame:
    """The health rule: `up == 0 or probe == 0`, the second only where the first has no sample."""
    down = [df.filter(F.col("value") == 0) for df in (up, probe)]
    either = vector_or(*(d.select("series", "ts", "value") for d in down), ["series", "ts"])
    every = up.select("series", "ts").unionByName(probe.select("series", "ts")).distinct()
    return condition(every.join(either, ["series", "ts"], "left"), "PluginUnhealthy")


def alerts(conditions: DataFrame) -> DataFrame:
    """`active, active_since, firing` of every rule's samples, ordered together once."""
    one = F.to_json(F.array("alert", "series"))
    rows = conditions.select("*", F.col("series").alias("_of")).withColumn("series", one)
    states = held(rows, F.col("active"), F.col("hold"))
    return states.drop("series", "hold").withColumnRenamed("_of", "series")


def level(kind: str, value: Column) -> Column:
    """`critical`, `warning` or `ok` by the fixed thresholds of this kind."""
    result = F.lit("ok")
    if kind in WARNING:
        result = F.when(value > WARNING[kind], "warning").otherwise(result)
    if kind in CRITICAL:
        result = F.when(value > CRITICAL[kind], "critical").otherwise(result)
    return result


def vector_ratio(left: DataFrame, right: DataFrame, keys: list[str], name: str) -> DataFrame:
    """`left / right` of samples with equal labels at the same moment, one to one."""
    right = right.select(*keys, "ts", F.col("value").alias("_divisor"))
    return left.join(right, [*keys, "ts"]).select(
        *keys, "ts", F.try_divide("value", "_divisor").alias(name)
    )


def per_scalar(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """`left / on() right`: `right` has one sample per moment, shared by all of `left`."""
    scalar = right.groupBy("ts").agg(F.max_by("value", "series").alias("_divisor"))
    return left.join(scalar, "ts").withColumn(
        name, F.try_divide("value", "_divisor")
    ).drop("_divisor")


def vector_or(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """All of `left`, and those of `right` whose labels `left` does not have."""
    return left.unionByName(right.join(left.select(*keys).distinct(), keys, "left_anti"))


def stalled(snapshots: DataFrame, width: int = HOUR) -> DataFrame:
    """Add `stalled`: the snapshot equals the one before it."""
    df = neighbour(snapshots, ["series"], ["ts"], {"snapshot": "_before"}, width=width)
    same = F.coalesce(F.col("snapshot") == F.col("_before"), F.lit(False))
    return df.withColumn("stalled", same).drop("_before")


def last_value(df: DataFrame, *keys: str) -> DataFrame:
    """Newest non-null value per key."""
    return df.filter(F.col("value").isNotNull()).groupBy(*keys).agg(
        F.max_by("value", "ts").alias("value")
    )


def _daily_availability(up: DataFrame) -> DataFrame:
    """`series, day`: microseconds up and microseconds known. A sample holds until the next one."""
    held_until = neighbour(up, ["series"], ["ts", "value"], {"ts": "_until"}, ahead=True)
    start, end = F.col("ts"), F.col("_until")
    last = (end - F.expr("INTERVAL 1 MICROSECOND")).cast("date")
    days = held_until.filter(end > start).select(
        "series", "ts", "_until", "value", F.explode(F.sequence(start.cast("date"), last)).alias("day"))
    midnight = micros(F.col("day").cast("timestamp_ntz"))
    inside = F.least(micros(end), midnight + 86_400_000_000) - F.greatest(micros(start), midnight)
    return days.groupBy("series", "day").agg(
        F.sum(F.when(F.col("value") > 0, inside).otherwise(0)).alias("up"), F.sum(inside).alias("known"))


def service_levels(
    up: DataFrame, traffic: DataFrame, bounds: tuple[float, ...], days: int = SLO_DAYS
) -> DataFrame:
    """Service levels of every series over the `days` that end with each day.

    `up`: samples (series, ts, value), a step function. `traffic`: counters (series, ts, `errors`,
    `enqueued`, `dropped` and the latency `buckets`, an array by bound), which may reset. Availability is the
    share of known time that was up; p95 comes from the histograms merged over the window. Days
    add up first; a window is the difference of two running totals, a row per series and day.
    """
    counters = {f"_b{i}": F.get("buckets", F.lit(i)) for i in range(len(bounds))}
    plain = ("errors", "enqueued", "dropped")
    flat = traffic.select("series", "ts", *plain, *(v.alias(n) for n, v in counters.items()))
    names = [*plain, *counters]
    grown = neighbour(flat, ["series"], ["ts"], {n: f"_was_{n}" for n in names})
    more = {n: F.coalesce(_grown(F.col(n), F.col(f"_was_{n}")), F.lit(0.0)) for n in names}
    moved = grown.groupBy("series", F.col("ts").cast("date").alias("day")).agg(
        *(F.sum(v).alias(n) for n, v in more.items()))
    daily = moved.join(_daily_availability(up), ["series", "day"], "full")
    ends = daily.groupBy("series").agg(F.min("day").alias("a"), F.max("day").alias("b"))
    calendar = ends.select("series", F.explode(F.sequence("a", "b")).alias("day"))
    sums = [*names, "up", "known"]
    order = Window.partitionBy("series").orderBy("day")
    every = calendar.join(daily, ["series", "day"], "left").fillna(0, sums)
    total = every.select("series", "day", *(F.sum(n).over(order).alias(n) for n in sums))
    inside = total.select("series", "day", *(
        (F.col(n) - F.lag(n, days, 0).over(order)).alias(n) for n in sums))
    p95 = F.get(bucket_quantiles(F.array(*counters), F.lit([float(b) for b in bounds]), (0.95,)), F.lit(0))
    measured_ = inside.select(
        "series", "day", F.try_divide("up", "known").alias("availability"),
        F.try_divide("errors", "enqueued").alias("error_ratio"), p95.alias("p95"), "dropped")
    return measured_.withColumns(
        {
            "availability_met": F.col("availability") >= AVAILABILITY_TARGET,
            "errors_met": F.col("error_ratio") < ERROR_RATIO_TARGET,
            "latency_met": F.col("p95") < LATENCY_TARGET,
            "no_loss": F.col("dropped") == 0,
        }
    )
