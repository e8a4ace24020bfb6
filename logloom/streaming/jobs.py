"""The batch operators on streams.

Input rates are bounded by the source (`maxFilesPerTrigger`, `maxBytesPerTrigger`); progress is
in the checkpoint of each query, so a restarted one repeats at most its last micro-batch, and
every sink here replaces a batch that is written twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from logloom.functions.once import once
from logloom.operators import bloom, clusters, counters, otel, routing
from logloom.options import RouteOptions
from logloom.session import settle
from logloom.sources.readers import corrupt, spread_if_narrow
from logloom.sources.sinks import sink_for
from logloom.streaming.log import BatchLog

Deliver = Callable[[DataFrame, int], None]


def start(
    stream: DataFrame, deliver: Deliver, checkpoint: str, interval: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Run until stopped with a flush interval, or drain what is there and stop."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    writer = stream.writeStream.outputMode(mode).foreachBatch(deliver)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _day(ts: str = "ts"):
    """The group of a stored file: its day, empty without one."""
    return F.coalesce(F.to_date(ts).cast("string"), F.lit(""))


def files_holding(records: DataFrame, path: str, before: int) -> list[str]:
    """Stored files of batches below `before` that may hold a record of `records`."""
    index = BatchLog(records.sparkSession, f"{path}/_index").read(before)
    if index is None:
        return []
    wanted = settle(records.select(_day().alias("group"), F.col("record_id").cast("string").alias("item")))
    days = wanted.select("group").distinct()
    return bloom.files_with_any(index.join(F.broadcast(days), "group", "left_semi"), wanted)


def deliver_once(path: str, merge_every: int = 64) -> Deliver:
    """Store each record one time however often and late it comes, by `record_id` and day of `ts`.

    A repeat has the time of its first copy. An index of Bloom filters by stored file, one delta a
    batch, tells which files of those days may hold a record of this batch; only these are opened. A
    batch that runs again replaces its own files and does not see them. A record without an id is
    no repeat of another: all are stored.
    """

    def deliver(records: DataFrame, batch_id: int) -> None:
        spark = records.sparkSession
        named = records.filter("record_id IS NOT NULL").dropDuplicates(["record_id"])
        batch = settle(named.unionByName(records.filter("record_id IS NULL")))
        files = files_holding(batch, path, batch_id)
        new = batch
        if files:
            known = spark.read.parquet(*files).select("record_id").filter("record_id IS NOT NULL")
            new = batch.join(known, "record_id", "left_anti").select(*batch.columns)
        folder = f"{path}/batch_id={batch_id}"
        new.withColumn("day", F.to_date("ts")).write.mode("overwrite").partitionBy("day").parquet(folder)
        written = spark.read.schema(batch.schema).parquet(folder)
        log = BatchLog(spark, f"{path}/_index")
        log.append(bloom.index_of(written.select(
            _day().alias("group"), bloom.stored_file().alias("file"),
            F.col("record_id").cast("string").alias("item"))), batch_id)
        if merge_every and batch_id % merge_every == merge_every - 1:
            log.merge()

    return deliver


# --- routes --------------------------------------------------------------------------------


def keep_routes(path: str, options: RouteOptions = RouteOptions(), merge_every: int = 64) -> Deliver:
    """Keep the effective cluster changes as a log: a batch writes its own changes and no more."""

    def deliver(changes: DataFrame, batch_id: int) -> None:
        log = BatchLog(changes.sparkSession, path)
        log.append(clusters.effective_changes(changes, options), batch_id)
        if merge_every and batch_id % merge_every == merge_every - 1:
            log.merge()

    return deliver


def kept_changes(spark: SparkSession, path: str) -> DataFrame:
    """All effective changes known now, each once."""
    return BatchLog(spark, path).read().dropDuplicates(["host", "seq"])


def latest_routes(spark: SparkSession, path: str, options: RouteOptions) -> DataFrame:
    """The routes of now."""
    return clusters.routes_of(kept_changes(spark, path), options)


def known_history(spark: SparkSession, path: str, options: RouteOptions) -> DataFrame:
    """The intervals of all routes, for records that come late."""
    return clusters.history_of(kept_changes(spark, path), options)


# --- records -------------------------------------------------------------------------------


def route_records(
    path: str, options: RouteOptions, routes: Callable[[], DataFrame | None], as_of: bool = False
) -> Deliver:
    """Decide and deliver each micro-batch with the routes known when it runs.

    With `as_of`, `routes` gives the known history, and a record gets the route of its own time
    however late it comes.

    Writes the ledger and its counters, and hands the records to the sink of their client type.
    The ledger is written first and read back, so a batch is parsed and decided one time.
    """

    def deliver(records: DataFrame, batch_id: int) -> None:
        spread = spread_if_narrow(records, "record_id")
        known = routes()  # computed once: joins measure it first
        if as_of:
            decided = routing.ledger_as_of(spread, known, options)
        else:
            decided = routing.ledger(spread, None if known is None else settle(known), options, settled=True)
        folder = f"{path}/ledger/batch_id={batch_id}"
        flat = decided.withColumn("record", F.to_json("fields")).drop("fields")
        flat.write.mode("overwrite").parquet(folder)
        written = records.sparkSession.read.parquet(folder)
        BatchLog(records.sparkSession, f"{path}/counters").append(counters.ledger_counters(written), batch_id)
        fields = F.try_variant_get(F.try_parse_json("record"), "$", "map<string,variant>")
        for client in dict.fromkeys((options.seed_type, options.shoot_type)):
            kind = routing.CLIENT_TYPES.get(client.upper(), "noop")
            mine = written.filter(F.exists("destinations", lambda d: d["client"] == kind))
            mine = once(mine, fields=fields).drop("record")
            # a record for two destinations is built one time
            built = mine if kind == "stdout" else otel.to_otel(mine, options)
            batch = routing.fan_out(built).filter(F.col("client") == kind)
            sink_for(client, f"{path}/{kind}").write(batch, batch_id)

    return deliver


def kept_counters(spark: SparkSession, *paths: str) -> DataFrame:
    """Counters of all batches of the logs at `paths`: those of records, and of lines that fail."""
    return counters.summed(*(BatchLog(spark, p).read() for p in paths))


def merge_counters(spark: SparkSession, path: str) -> None:
    BatchLog(spark, path).merge(counters.summed)


def count_corrupt(path: str, source: str) -> Deliver:
    """Count the lines of a stream of `json_lines` that do not parse, and keep their text."""

    def deliver(lines: DataFrame, batch_id: int) -> None:
        failed = corrupt(lines, source)
        failed.write.mode("overwrite").parquet(f"{path}/lines/batch_id={batch_id}")
        written = lines.sparkSession.read.schema(failed.schema).parquet(f"{path}/lines/batch_id={batch_id}")
        BatchLog(lines.sparkSession, f"{path}/counters").append(counters.malformed_lines(written), batch_id)

    return deliver


def write_batches(path: str) -> Deliver:
    """Store each micro-batch in its own folder."""

    def deliver(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return deliver


def count_batches(path: str, *by: str, every: str = "30 seconds") -> Deliver:
    """Records per tumbling interval, stored for each micro-batch.

    No watermark: a record of any age is counted in its own interval, and `interval_counts` adds
    the batches up.
    """

    def deliver(records: DataFrame, batch_id: int) -> None:
        tick = F.window("ts", every)
        counted = records.groupBy(tick.alias("tick"), *by).agg(F.count(F.lit(1)).alias("records"))
        counted.select(F.col("tick.start").alias("tick"), *by, "records").write.mode(
            "overwrite").parquet(f"{path}/batch_id={batch_id}")

    return deliver


def interval_counts(spark: SparkSession, path: str, *by: str) -> DataFrame:
    """Sums over all batches of `count_batches`."""
    return spark.read.parquet(path).groupBy("tick", *by).agg(F.sum("records").alias("records"))


# --- mute flags ----------------------------------------------------------------------------

FLAGS = "host string, seq bigint, live boolean, to_shoot boolean, to_seed boolean"


def flags_processor(policy: dict[str, tuple[bool, bool]]) -> StatefulProcessor:
    """The processor of `mute_flags`. Its class is made here, so it travels to the workers by value."""

    class Flags(StatefulProcessor):
        """One row of state per cluster: the change that decided last, and the two flags it left."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.state = handle.getValueState("flags", "seq bigint, live boolean, to_shoot boolean, to_seed boolean")

        def handleInputRows(self, key, rows, timerValues):
            import pandas as pd

            seq, live, shoot, seed = self.state.get() or (-1, False, False, False)
            before = seq
            for changes in rows:
                for change in changes.sort_values("seq").itertuples():
                    if change.seq <= seq:  # late or repeated
                        continue
                    seq = int(change.seq)
                    if change.action == "remove":
                        live, shoot, seed = False, False, False
                        continue
                    # an unknown state keeps the flags; a new cluster with one starts with both off
                    live, (shoot, seed) = True, policy.get(change.state, (shoot, seed))
            if seq != before:
                self.state.update((seq, live, shoot, seed))
                yield pd.DataFrame({"host": [key[0]], "seq": [seq], "live": [live], "to_shoot": [shoot],
                                    "to_seed": [seed]})

        def close(self) -> None:
            pass

    return Flags()


def mute_flags(effective: DataFrame, options: RouteOptions) -> DataFrame:
    """Flags of every cluster that a micro-batch changes, from state kept by cluster.

    `effective` is a stream with `host, seq, action, state`. The session must use the RocksDB state
    store (`use_state_store`).
    """
    policy = {state: tuple(pair) for state, pair in options.policy.items()}
    return effective.select("host", "seq", "action", "state").groupBy("host").transformWithStateInPandas(
        flags_processor(policy), outputStructType=FLAGS, outputMode="Update", timeMode="None")


def use_state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def keep_flags(path: str, merge_every: int = 64) -> Deliver:
    """Keep the changed flags as a log, merged to one row per cluster."""

    def deliver(flags: DataFrame, batch_id: int) -> None:
        log = BatchLog(flags.sparkSession, path)
        log.append(flags, batch_id)
        if merge_every and batch_id % merge_every == merge_every - 1:
            log.merge(_newest)

    return deliver


def _newest(flags: DataFrame) -> DataFrame:
    last = flags.groupBy("host").agg(F.max_by(F.struct("seq", "live", "to_shoot", "to_seed"), "seq").alias("f"))
    return last.select("host", "f.*")


def kept_flags(spark: SparkSession, path: str) -> DataFrame:
    """`host, to_shoot, to_seed` of every live cluster."""
    return _newest(BatchLog(spark, path).read()).filter("live").select("host", "to_shoot", "to_seed")
