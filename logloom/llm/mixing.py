"""Mixing sources to target weights by packed blocks.

The words of a source form one stream, cut into blocks of `BLOCK` words. Every output shard draws
its source counts; a source's draws over all shards are conditioned on its quota of slots, so the
multinomial draws become multivariate hypergeometric ones and no target is missed by chance. The
counts come from a tree that halves the range of shards, so each task draws its own shards alone.
Slot k of a source is block `permutation(epoch, k mod blocks)` of epoch `k div blocks`, and blocks
are joined by that index.

Defined cases: NULL text has no words and is never taken. A NULL source is a source and comes last
among the weights. Rows with equal ids are separate documents, in the order of id and size; their
results are equal up to that order. Empty tables give empty results. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions.once import once
from logloom.llm.common import SPACE_RUN, packed, same_row, ship, stored, word_count
from logloom.operators.lookup import lookup_join

WEIGHTS = (1, 2, 3)
EPOCHS = 3
BLOCK = 128
SHARD_SLOTS = 4096
SEED = 20
#: Documents of one source whose places are summed in one task.
PLACED_TOGETHER = 5_000


def targets(sized: DataFrame) -> DataFrame:
    """One row per source: number, size, target, blocks and slots.

    Shares follow the weights; a target stops at `EPOCHS` times its size. Sources sorted by size
    per weight are capped from the front as long as the level that the rest would get exceeds
    their cap, which is where resharing ends.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*(F.lit(w) for w in WEIGHTS))
    rows = sums.withColumn("source_no", F.row_number().over(named) - 1).withColumn(
        "weight", F.get(weights, F.col("source_no") % len(WEIGHTS)))
    cap = EPOCHS * F.col("source_size")
    order = Window.orderBy(cap / F.col("weight"), "source_no")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rows = rows.withColumn("level", (
        F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    capped = cap < F.col("level") * F.col("weight")
    rows = rows.withColumn("level", F.max(F.when(~capped, F.col("level"))).over(everything))
    rows = rows.withColumn("target", F.least(
        cap.cast("double"), F.coalesce(F.col("level") * F.col("weight"), cap.cast("double"))))
    blocks = F.ceil(F.col("source_size") / BLOCK)
    slots = F.when(F.col("source_size") > 0, F.least(
        F.round(F.col("target") * blocks / F.col("source_size")).cast("long"), EPOCHS * blocks))
    return rows.select(
        "source", F.col("source_no").cast("int").alias("source_no"), "source_size", "target",
        blocks.cast("long").alias("blocks"), F.coalesce(slots, F.lit(0)).cast("long").alias("slots"))


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """Pseudorandom permutation of 0..size-1: a four-round Feistel network with cycle walking."""
    half = max(1, (int(size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    shift = np.uint64(half)

    def mixed(x: np.ndarray, round_no: int) -> np.ndarray:
        start = (key * 4 + round_no + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
        z = (x + np.uint64(start)) * np.uint64(0xBF58476D1CE4E5B9)
        z ^= z >> np.uint64(29)
        z *= np.uint64(0x94D049BB133111EB)
        return (z ^ (z >> np.uint64(32))) & mask

    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            left, right = out[todo] >> shift, out[todo] & mask
            for r in range(4):
                left, right = right, left ^ mixed(right, r)
            out[todo] = (left << shift) | right
            todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def drawn(quota: np.ndarray, shards: int, first: int, last: int) -> Iterator[tuple]:
    """(shard, first slots, counts) for shards first..last-1 of `shards`, by halving the range."""
    total = int(quota.sum())

    def size(low: int, high: int) -> int:
        return min(total, high * SHARD_SLOTS) - min(total, low * SHARD_SLOTS)

    def walk(low: int, high: int, start: np.ndarray, have: np.ndarray):
        if high <= first or low >= last:
            return
        if high - low == 1:
            yield low, start, have
            return
        middle = (low + high) // 2
        rng = np.random.default_rng([SEED, low, high])
        left = np.zeros_like(have)
        want, rest = size(low, middle), int(have.sum())
        for s, n in enumerate(have):
            if want and n:
                left[s] = hypergeometric(rng, int(n), rest - int(n), want)
                want -= int(left[s])
            rest -= int(n)
        yield from walk(low, middle, start, left)
        yield from walk(middle, high, start + left, have - left)

    yield from walk(0, shards, np.zeros_like(quota), quota)


def hypergeometric(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """numpy's draw; beyond its range, the normal limit, which no count of slots can tell apart."""
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, sample))
    whole = good + bad
    mean = sample * good / whole
    spread = (mean * (bad / whole) * (whole - sample) / (whole - 1)) ** 0.5
    low, high = max(0, sample - bad), min(good, sample)
    return int(min(high, max(low, round(rng.normal(mean, spread)))))


def slots(spark, sources: list) -> DataFrame:
    """`shard, position, source_no, epoch, block`: every slot of the mix and the block in it.

    `sources` are the rows of `targets`, one per source: their number bounds what tasks receive.
    """
    ship(spark)
    sources = sorted(sources, key=lambda r: r.source_no)
    quota = np.array([r.slots for r in sources], dtype=np.int64)
    blocks = [r.blocks for r in sources]
    shards = -(-int(quota.sum()) // SHARD_SLOTS)

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low in batch["id"]:
                for shard, start, count in drawn(quota, shards, int(low), int(low) + 1):
                    no = np.repeat(np.arange(len(count), dtype=np.int32), count)
                    epoch = np.zeros(len(no), dtype=np.int32)
                    block = np.zeros(len(no), dtype=np.int64)
                    for s in np.flatnonzero(count):
                        k = np.arange(start[s], start[s] + count[s])
                        for e in np.unique(k // blocks[s]):
                            here = k // blocks[s] == e
                            where = np.flatnonzero(no == s)[here]
                            epoch[where] = e
                            block[where] = permuted(
                                k[here] % blocks[s], blocks[s], (SEED + int(s)) * EPOCHS + int(e))
                    place = np.random.default_rng([SEED, shard]).permutation(len(no))
                    yield pd.DataFrame({
                        "shard": np.full(len(no), shard, dtype=np.int64),
                        "position": place.astype(np.int32), "source_no": no, "epoch": epoch,
                        "block": block})

    tasks = max(1, min(shards, 4 * spark.sparkContext.defaultParallelism))
    made = spark.range(0, shards, 1, tasks).mapInPandas(
        fill, "shard long, position int, source_no int, epoch int, block long")
    return made.hint("merge")  # a few shards make many slots, which the planner cannot see


def placed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """`sized` with its source's figures and `start`, the document's first word in the stream.

    The stream is ordered by bucket, then id, then size. Buckets come from a hash of the id, so
    a source of any size is summed by many tasks, and bucket totals are summed after that.
    """
    rows = lookup_join(sized, sources.withColumnRenamed("source_size", "whole").withColumn(
        "named", F.to_json(F.array("source"))).drop("source"), ["named"], spread="doc_id")
    buckets = int(sized.count() // PLACED_TOGETHER) + 1
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
    inside = Window.partitionBy("source_no", "bucket").orderBy("doc_id", "size")
    rows = rows.withColumn(
        "up_to", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    sums = rows.groupBy("source_no", "bucket").agg(F.sum("size").alias("all"))
    earlier = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    sums = sums.select("source_no", "bucket",
                       F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("before"))
    rows = lookup_join(rows, sums, ["source_no", "bucket"], spread="doc_id")
    return rows.withColumn("start", F.col("before") + F.col("up_to") - F.col("size"))


def pieces(rows: DataFrame) -> DataFrame:
    """`rows` once for each block that a document has words in: `block`, `low`, `high`.

    `low` and `high` bound the document's own words (0-based, end excluded) in the block.
    """
    first = F.expr(f"start div {BLOCK}")
    last = F.expr(f"(start + size - 1) div {BLOCK}")
    cut = rows.filter("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    low = F.greatest(F.col("block") * BLOCK - F.col("start"), F.lit(0))
    high = F.least((F.col("block") + 1) * BLOCK - F.col("start"), F.col("size"))
    return cut.withColumns({"low": low, "high": high})


def sizes(docs: DataFrame) -> DataFrame:
    return stored(docs.select(
        "doc_id", "source", F.xxhash64("text").alias("_text"),
        word_count(F.col("text")).alias("size"),
        F.to_json(F.array("source")).alias("named")), "sizes")


def mix(docs: DataFrame) -> DataFrame:
    """Every document with `size`, `source_size`, `target` and `taken`, the words the mix takes."""
    sized = sizes(docs)
    sources = stored(targets(sized), "targets")
    rows = stored(placed(sized, sources), "placed")
    times = slots(docs.sparkSession, sources.collect()).groupBy("source_no", "block").agg(
        F.count(F.lit(1)).alias("times")).hint("merge")
    taken = pieces(rows.select("source_no", "start", "size")).join(
        times, ["source_no", "block"]).groupBy("source_no", "start").agg(
        F.sum((F.col("high") - F.col("low")) * F.col("times")).alias("taken"))
    own = rows.select(
        "doc_id", "source", "_text", "size", F.col("whole").alias("source_size"), "target",
        "source_no", "start", F.when(F.col("size") > 0, F.col("start")).alias("key"))
    taken = taken.select(F.col("source_no").alias("no"), F.col("start").alias("at"), "taken")
    return own.join(taken, (F.col("source_no") == F.col("no")) & (F.col("key") == F.col("at")),
                    "left").select(
        "doc_id", "source", "size", "source_size", "target", "start",
        F.coalesce("taken", F.lit(0)).alias("taken"))


def mixed_blocks(docs: DataFrame) -> DataFrame:
    """The mix itself: `shard, position, source, epoch, block, words`, blocks joined by index.

    `words` are the block's words; a block holds at most `BLOCK` words, so the lists are bounded.
    """
    sized = sizes(docs)
    sources = stored(targets(sized), "targets")
    rows = placed(sized, sources)
    cut = pieces(rows).select("doc_id", "_text", "source_no", "start", "block", "low", "high")
    texts = once(docs.select(
        F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_key"), "text"),
        all_words=F.filter(F.split(F.coalesce("text", F.lit("")), SPACE_RUN), lambda x: x != ""))
    texts = texts.dropDuplicates(["_id", "_key"])
    parts = cut.join(texts, F.col("doc_id").eqNullSafe(F.col("_id")) & (
        F.col("_text") == F.col("_key"))).select(
        "source_no", "block", "start",
        F.expr("slice(all_words, int(low) + 1, int(high - low))").alias("part"))
    blocks = parts.groupBy("source_no", "block").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("start", "part"))), lambda x: x["part"]
    )).alias("words"))
    names = sources.select("source_no", "source")
    return slots(docs.sparkSession, sources.collect()).join(
        blocks, ["source_no", "block"]).join(names, "source_no").select(
        "shard", "position", "source", "epoch", "block", "words")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents: for each epoch, the words of a document that its blocks bring.

    Neighbouring words keep the white space between them, so a document taken whole is as it was;
    one taken in two epochs is there twice. Of rows with equal id, text and source each has its own
    place in the mix; what it brings has the other columns of one of them.
    """
    same = sizes(docs).groupBy("doc_id", "_text", "size", "source", "named").agg(
        F.count(F.lit(1)).alias("copies"))
    sized = stored(same.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop(
        "copies"), "sizes")
    sources = stored(targets(sized), "targets")
    rows = placed(sized, sources)
    picked = slots(docs.sparkSession, sources.collect()).select("source_no", "block", "epoch")
    ranges = pieces(rows).join(picked, ["source_no", "block"]).groupBy(
        "doc_id", "_text", "source", "copy", "epoch").agg(F.sort_array(F.collect_list(F.struct(
            F.col("low").cast("int").alias("low"), F.col("high").cast("int").alias("high")
        ))).alias("ranges"))
    ranges = ranges.groupBy("doc_id", "_text", "source", "copy").agg(
        F.sort_array(F.collect_list(F.struct("epoch", "ranges"))).alias("epochs"))
    ranges = ranges.select(F.col("doc_id").alias("_id"), "_text", F.col("source").alias("_source"), "epochs")
    own = packed(docs).withColumn("_own_source", F.col("_row.source")).dropDuplicates(
        ["_own_id", "_own_text", "_own_source"])
    both = own.join(ranges, same_row() & F.col("_own_source").eqNullSafe(F.col("_source")))
    units = F.regexp_extract_all(F.col("_row.text"), F.lit(
        "[ \\t\\n\\x0B\\f\\r]*[^ \\t\\n\\x0B\\f\\r]+[ \\t\\n\\x0B\\f\\r]*"), F.lit(0))
    both = once(both, _units=units).withColumn("_one", F.explode("epochs"))
    parts = F.transform(F.col("_one.ranges"), lambda r: F.array_join(
        F.slice(F.col("_units"), r["low"] + 1, r["high"] - r["low"]), ""))
    both = once(both, _out=F.array_join(parts, ""))
    out = {"text": F.col("_out"), "n_chars": F.length("_out").cast("long")}
    return both.select(*(
        (out[c] if c in out else F.col("_row").getField(c)).alias(c) for c in docs.columns))
