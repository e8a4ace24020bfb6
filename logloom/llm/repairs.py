"""Conversation structure repair: the cheapest edits that make the roles of a conversation legal.

Equal turns are counted first and repeats are found by grouping, so neither gathers anywhere. Turns
are then sorted by range over all tasks and cut into segments of bounded length; a conversation
may span many segments and tasks. For each top of the parser's stack that a segment may begin
with, a task finds the cheapest (cost, audit) to each top it may end with (`grammar`). A
conversation's segments are joined by these few rows each, and every segment then applies its part
of the audit by itself.

Defined cases: a NULL role or text is one space. Turns are ordered by number, NULL first, then
role and text; equal rows are repeats of each other. A role without a character has no initial
and cannot be kept. NULL is a conversation of its own. An empty table gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm import grammar
from logloom.llm.common import ship, stored
from logloom.operators.lookup import lookup_join

SEGMENT = 2_000
TURNS_PER_TASK = 50_000
BLANK, DUPLICATE, CUT_OFF = 1, 2, 3
LEGAL = ("su", "ua", "au")

TURN = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("n", pa.int64()),
                  ("fault", pa.int32())])
MOVE = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()),
                  ("audit", pa.string())])
SEGMENTS = pa.schema([
    ("conv_id", pa.int64()), ("place", pa.int64()), ("turns", pa.list_(TURN)), ("head", pa.string()),
    ("tail", pa.string()), ("illegal", pa.int64()), ("moves", pa.list_(MOVE))])
SEGMENTS_DDL = (
    "conv_id long, place long, turns array<struct<turn:long,role:string,text:string,n:long,fault:int>>, "
    "head string, tail string, illegal long, "
    "moves array<struct<entry:int,exit:int,cost:long,audit:string>>")


class Repair(NamedTuple):
    """`summary`: a row per conversation. `segments`: the repaired turns in order of `place`."""

    summary: DataFrame
    segments: DataFrame


def fault_of(text: Column, repeated: Column) -> Column:
    """The first fault of a turn as a number, 0 if it has none."""
    return (
        F.when(~text.rlike(r"[^\x20\x09-\x0D]"), BLANK)
        .when(repeated, DUPLICATE)
        .when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), CUT_OFF)
        .otherwise(0))


def faulty(turns: DataFrame) -> DataFrame:
    """Different rows of `turns` with their number `n` and the `fault` of the first of them."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), *spaced)
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    said = F.sha2(F.to_json(F.struct("conv_id", "role", "text")), 256)
    rows = stored(rows.withColumn("said", said), "turns")
    at = F.struct(F.col("turn").isNotNull().alias("has"), F.coalesce("turn", F.lit(0)).alias("turn"))
    first = rows.groupBy("said").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("k"))
    met = lookup_join(rows, first.filter("k > 1").drop("k"), ["said"], spread="turn")
    repeated = F.coalesce(at > F.col("first"), F.lit(False))
    return stored(met.select("conv_id", "turn", "role", "text", "n",
                             fault_of(F.col("text"), repeated).alias("fault")), "faults")


def described(turns: list[tuple]) -> list[tuple[str, bool, bool]]:
    """What the grammar has to know of each row, repeats spelled out."""
    out = []
    for _, role, _, n, fault in turns:
        out.append((role[:1], fault in (BLANK, DUPLICATE), fault == CUT_OFF))
        out += [(role[:1], True, False)] * (n - 1)
    return out


def segments_of(rows: DataFrame) -> DataFrame:
    """Turns in order, cut into segments with the moves between stack tops; computed once."""
    spark, bound = rows.sparkSession, SEGMENT
    ship(spark)

    def segment(conv, place, turns, alone) -> tuple:
        told = described(turns)
        pairs = [a[0] + b[0] for a, b in zip(told, told[1:])]
        entries = (0,) if alone else grammar.ENTRIES
        moves = [m for e in entries for m in grammar.transfers(e, told)]
        return (conv, place, [dict(zip(("turn", "role", "text", "n", "fault"), t)) for t in turns], told[0][0],
                told[-1][0], sum(p not in LEGAL for p in pairs),
                [dict(zip(("entry", "exit", "cost", "audit"), m)) for m in moves])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 32
        conv, turns, length, sure, ready, size = object(), [], 0, False, [], 0

        def batch():
            return pa.RecordBatch.from_pylist([dict(zip(SEGMENTS.names, r)) for r in ready], SEGMENTS)

        for got in batches:
            for row in zip(*(got.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "n", "fault"))):
                if turns and (row[0] != conv or length >= bound):
                    ready.append(segment(conv, place, turns, sure))
                    # a conversation that begins inside a task begins with its first turn
                    place, turns, length, sure = place + 1, [], 0, row[0] != conv
                conv = row[0]
                left = row[4]
                while length + left > 2 * bound:  # a row with very many copies
                    turns.append((*row[1:4], bound, row[5]))
                    ready.append(segment(conv, place, turns, sure))
                    place, turns, length, sure, left = place + 1, [], 0, False, left - bound
                    row = (*row[:5], row[5] if row[5] == BLANK else DUPLICATE)
                turns.append((*row[1:4], left, row[5]))
                length, size = length + left, size + len(row[3])
                if len(ready) >= 1000 or size > 8 << 20:
                    if ready:
                        yield batch()
                    ready, size = [], 0
        if turns:
            ready.append(segment(conv, place, turns, sure))
        if ready:
            yield batch()

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // TURNS_PER_TASK)
    order = ["conv_id", "turn", "role", "text"]
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return stored(placed.mapInArrow(cut, SEGMENTS_DDL), "segments")


def decided(segments: DataFrame) -> DataFrame:
    """`conv_id`, `cost`, `illegal`, `audit` and the `parts` of the audit by segment."""
    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, rows in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "rows"))):
                cost, parts = grammar.joined(
                    [[(m["entry"], m["exit"], m["cost"], m["audit"]) for m in r["moves"]] for r in rows])
                pairs = [a["tail"] + b["head"] for a, b in zip(rows, rows[1:])]
                out.append({
                    "conv_id": conv, "cost": cost, "audit": "".join(a for _, a in parts),
                    "illegal": sum(r["illegal"] for r in rows) + sum(p not in LEGAL for p in pairs),
                    "parts": [{"place": r["place"], "entry": e, "audit": a} for r, (e, a) in zip(rows, parts)]})
            yield pa.RecordBatch.from_pylist(out, schema)

    part = pa.struct([("place", pa.int64()), ("entry", pa.int32()), ("audit", pa.string())])
    schema = pa.schema([("conv_id", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
                        ("illegal", pa.int64()), ("parts", pa.list_(part))])
    rows = segments.groupBy("conv_id").agg(F.array_sort(F.collect_list(
        F.struct("place", "head", "tail", "illegal", "moves"))).alias("rows"))
    return stored(rows.mapInArrow(
        choose, "conv_id long, cost long, audit string, illegal long, "
        "parts array<struct<place:long,entry:int,audit:string>>"), "decided")


def repair(turns: DataFrame) -> Repair:
    """Repair `turns` (conv_id, turn, role, text).

    `summary`: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. `segments`:
    conv_id, place and the array `repaired` of (role, text, edit).
    """
    rows = faulty(turns)
    segments = segments_of(rows)
    choice = decided(segments)

    def carry_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                listed = [(t["role"], t["text"]) for t in row["turns"] for _ in range(t["n"])]
                done = grammar.apply(row["entry"], row["audit"], listed)
                out.append({"conv_id": row["conv_id"], "place": row["place"],
                            "repaired": [dict(zip(("role", "text", "edit"), t)) for t in done]})
            yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("repaired", pa.list_(
        pa.struct([(c, pa.string()) for c in ("role", "text", "edit")])))])
    parts = choice.select(F.inline("parts")).withColumnRenamed("place", "_place")
    done = segments.select("conv_id", "place", "turns").join(
        parts, F.col("place") == F.col("_place")).drop("_place")
    repaired = done.mapInArrow(carry_out, "conv_id long, place long, "
                               "repaired array<struct<role:string,text:string,edit:string>>")

    fault, n = F.col("fault"), F.col("n")
    by_turn = rows.groupBy("conv_id", "turn").agg(
        F.sum(F.when(fault == BLANK, n).otherwise(0)).alias("blank"),
        F.sum(F.when(fault == DUPLICATE, n).when(fault == BLANK, 0).otherwise(n - 1)).alias("duplicate"),
        F.sum((fault == CUT_OFF).cast("long")).alias("truncated"))
    counts = by_turn.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))
    chosen = choice.drop("parts").withColumnRenamed("conv_id", "_conv")
    summary = counts.join(chosen, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    return Repair(summary, repaired)


def digests(segments: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's `role:text` lines; one string, so its lines meet in one task."""
    lines = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    text = F.when(F.size("repaired") > 0, F.concat_ws("\n", lines))
    listed = segments.select("conv_id", F.struct("place", text.alias("text")).alias("part"))
    return listed.groupBy("conv_id").agg(F.sha2(F.concat_ws("\n", F.transform(
        F.array_sort(F.collect_list("part")), lambda p: p["text"])), 256).alias("repaired_sha256"))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns damaged by a checksum of their place: dropped, emptied, cut off, repeated or reroled."""
    def spaced(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    text = F.when(kind == 1, "").when(
        kind == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    return turns.filter(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(spaced("role")).alias("role"),
        text.alias("text"), F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("_copy")
    ).drop("_copy")


def all_conversations(conversations: DataFrame, found: Repair) -> DataFrame:
    """A row for every conversation of the original table, those without turns included."""
    summary = found.summary.withColumnRenamed("conv_id", "_conv")
    digest = digests(found.segments).withColumnRenamed("conv_id", "_digest_of")
    own = conversations.select(F.col("conv_id").cast("long")).distinct()
    rows = own.join(summary, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").join(
        digest, F.col("conv_id").eqNullSafe(F.col("_digest_of")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return rows.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
