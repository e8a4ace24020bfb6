"""From raw input to records: line parsers, record transforms, tags.

A record is `fields MAP<STRING, VARIANT>` next to `ts`, `tag` and a `record_id`.
Every transform is `DataFrame -> DataFrame`, so a chain is `df.transform(f).transform(g)`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.once import once
from logloom.functions.patterns import tag_matches
from logloom.functions.severity import unify_severity
from logloom.functions.values import put, record_fields, string_of

Transform = Callable[[DataFrame], DataFrame]

# Field names of a reprojected journal record.
JOURNAL_FIELDS = {
    "MESSAGE": "log",
    "_EXE": "process.command",
    "_CMDLINE": "process.command_line",
    "_PID": "process.pid",
    "_MACHINE_ID": "host.id",
    "_SYSTEMD_UNIT": "service.name",
    "_SYSTEMD_SLICE": "service.namespace",
}


def apply(df: DataFrame, *transforms: Transform) -> DataFrame:
    """User extension point: run record transforms in order."""
    for transform in transforms:
        df = df.transform(transform)
    return df


def json_records(df: DataFrame, line: str = "line") -> DataFrame:
    """Decode JSON lines; text that is not an object becomes the `log` of a record."""
    decoded = record_fields(F.try_parse_json(line))
    raw = F.create_map(F.lit("log"), F.col(line).cast("variant"))
    return once(df, fields=F.coalesce(decoded, raw)).drop(line)


def pair_records(df: DataFrame, pairs: str = "pairs") -> DataFrame:
    """Typed key/value pairs to a record; keys that are not strings are dropped and counted.

    `pairs` is ARRAY<STRUCT<key_type STRING, key STRING, value BINARY>>.
    """
    usable = F.filter(pairs, lambda p: p["key_type"] == "string")
    entries = F.transform(
        usable, lambda p: F.struct(p["key"], p["value"].cast("string").cast("variant"))
    )
    return once(
        df,
        fields=F.map_from_entries(entries),
        invalid_keys=F.size(pairs) - F.size(usable),
    ).drop(pairs)


def normal_time(source: Column, unix_seconds: Column | None = None) -> Column:
    """Text time, else unix seconds, else now."""
    choices = [F.try_to_timestamp(source)]
    if unix_seconds is not None:
        choices.append(F.timestamp_seconds(unix_seconds))
    return F.coalesce(*choices, F.current_timestamp())


def container_lines(df: DataFrame, line: str = "value", arrival: str = "file_ts") -> DataFrame:
    """`<time> <stdout|stderr> <logtag> <message>`; a line of another form is kept as `log`.

    Adds the four parts, `ts` and the fraction in `nanos`. Every line has a time: its own, else
    that of the column `arrival` if there is one, else now.
    """
    parts = F.split(F.col(line), " ", 4)
    fits = (
        (F.size(parts) == 4)
        & (F.get(parts, F.lit(0)) != "")
        & F.get(parts, F.lit(1)).isin("stdout", "stderr")
    )

    arrived = [F.col(arrival).cast("timestamp")] if arrival in df.columns else []

    def part(i: int) -> Column:
        return F.when(fits, F.get(parts, F.lit(i)))

    fraction = F.regexp_extract(part(0), r"\.(\d{1,9})", 1)
    nanos = F.when(fits, F.coalesce(F.try_to_number(F.rpad(fraction, 9, "0"), F.lit("999999999")),
                                    F.lit(0)).cast("bigint"))
    return df.withColumns(
        {
            "time": part(0),
            "stream": part(1),
            "logtag": part(2),
            "message": part(3),
            "log": F.when(~F.coalesce(fits, F.lit(False)), F.col(line)),
            "ts": F.coalesce(F.try_to_timestamp(part(0)), *arrived, F.current_timestamp()),
            "nanos": nanos,
        }
    ).drop(line, arrival)


def container_records(df: DataFrame) -> DataFrame:
    """Parsed container lines to records."""
    names = ("time", "stream", "logtag", "message", "log")
    record = F.parse_json(F.to_json(F.struct(*names)))
    return once(df, fields=record_fields(record)).drop(*names)


def decode_field(key: str = "log") -> Transform:
    """Replace a text field that holds JSON by its decoded value."""

    def run(df: DataFrame) -> DataFrame:
        decoded = F.try_parse_json(string_of(F.col("fields")[key]))
        return df.withColumn("fields", put(F.col("fields"), key, decoded))

    return run


def add_tag(key: str = "tag") -> Transform:
    return lambda df: df.withColumn("fields", put(F.col("fields"), key, F.col("tag")))


def record_time(ts: Column, nanos: Column) -> Column:
    """UTC time text; the nanoseconds are printed without padding."""
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("."), nanos.cast("string"), F.lit("Z")
    )


def set_time(df: DataFrame) -> DataFrame:
    """Set `time` of records that have a `logtag`, from `ts` and `nanos`."""
    time = F.when(F.col("fields")["logtag"].isNotNull(), record_time(F.col("ts"), F.col("nanos")))
    return df.withColumn("fields", put(F.col("fields"), "time", time))


def unify_severity_field(df: DataFrame) -> DataFrame:
    unified = unify_severity(string_of(F.col("fields")["severity"]))
    return df.withColumn("fields", put(F.col("fields"), "severity", unified))


def passed_columns(df: DataFrame) -> list[str]:
    return [c for c in ("ts", "nanos", "tag", "record_id") if c in df.columns]


def journal_columns(df: DataFrame) -> DataFrame:
    """A journal entry reduced to the kept fields under their new names, plus `time`."""
    return df.select(
        *passed_columns(df),
        record_time(F.col("ts"), F.col("nanos")).alias("time"),
        *(F.col(source).alias(name) for source, name in JOURNAL_FIELDS.items()),
    )


def journal_records(df: DataFrame) -> DataFrame:
    columns = journal_columns(df)
    names = ["time", *JOURNAL_FIELDS.values()]
    record = F.parse_json(F.to_json(F.struct(*(F.col(f"`{n}`") for n in names))))
    return once(columns, fields=record_fields(record)).select(*passed_columns(df), "fields")


def constant_by_tag(values: dict[str, str]) -> Column:
    """The constant of the first tag glob that matches `tag`, else NULL."""
    return F.coalesce(
        *(F.when(tag_matches(F.col("tag"), glob), F.lit(v)) for glob, v in values.items())
    )


def set_constant(key: str, values: dict[str, str]) -> Transform:
    return lambda df: df.withColumn("fields", put(F.col("fields"), key, constant_by_tag(values)))


def only_tags(glob: str) -> Transform:
    return lambda df: df.filter(tag_matches(F.col("tag"), glob))
