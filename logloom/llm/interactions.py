"""Filter interaction audit over a sparse document-term matrix.

Tasks read whole texts into shards of documents in compressed sparse rows, whose entries point
into the shard's list of words. The words' columns are global: a word is encoded by a 64-bit hash,
so every shard knows its columns without asking, and the dictionary of all words is built to prove
that no two of them share a code (otherwise the next seed is taken). The dictionary has a row for
a word and shard however often it occurs, combined before the shuffle, so no word is a hot key.

Row sums are the words of a document, nonzero counts its distinct words; they decide two filters.
The flags of the others are attached, documents are counted by the set of filters that they fail,
and all orders of the filters follow from these at most 32 counts a part.

Filters: A under 50 words; B distinct words under 65 % of words; C capitals over 5 % of code
points; D a character of `#$%&*|`; E the text of a smaller doc_id, wherever it is.

Defined cases: words are case-sensitive runs of bytes between ASCII white space. A NULL text is
empty and a NULL source is the empty string. Equal texts are told by a 128-bit digest. A NULL
doc_id is neither smaller nor larger than another, so its row never fails E; rows that share id
and text do not make each other fail. A document with several labels is good or toxic if one of
them says so; labels without doc_id are ignored. An empty table gives no rows, an empty table of
labels no lost documents. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import ship, stored
from logloom.operators.lookup import lookup_join

MIN_WORDS = 50
DISTINCT_SHARE = 65
CAPITAL_SHARE = 5
SYMBOLS = re.compile(rb"[#$%&*|]")
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
FILTERS = "ABCDE"

#: A shard ends after the document with which it reaches one of these.
SHARD_WORDS = 250_000
SHARD_ENTRIES = 2_000_000

FACTS = pa.struct([("doc_id", pa.int64()), ("part", pa.string()), ("flags", pa.int32()),
                   ("digest", pa.binary())])
LOCAL = pa.schema([
    ("shard", pa.int64()), ("facts", pa.list_(FACTS)), ("vocabulary", pa.list_(pa.binary())),
    ("indptr", pa.list_(pa.int64())), ("places", pa.list_(pa.int32())),
    ("counts", pa.list_(pa.int32()))])
FACTS_DDL = "array<struct<doc_id:long,part:string,flags:int,digest:binary>>"
LOCAL_DDL = (f"shard long, facts {FACTS_DDL}, vocabulary array<binary>, indptr array<long>, "
             "places array<int>, counts array<int>")


class Shard:
    """Compressed sparse rows of some documents over the words that occur in them."""

    def __init__(self):
        self.places: dict[bytes, int] = {}
        self.facts, self.indptr, self.columns, self.counts = [], [0], [], []

    def add(self, doc_id: int | None, source: str | None, text: str | None) -> None:
        raw = (text or "").encode()
        counted = Counter(raw.split())
        places, known = self.places, self.places.setdefault
        self.columns.append(np.fromiter((known(w, len(places)) for w in counted), np.int32, len(counted)))
        self.counts.append(np.fromiter(counted.values(), np.int32, len(counted)))
        self.indptr.append(self.indptr[-1] + len(counted))
        capitals = len(raw) - len(raw.translate(None, CAPITALS))
        flags = ((100 * capitals > CAPITAL_SHARE * len(text or "")) << 2) | (
            (SYMBOLS.search(raw) is not None) << 3)
        self.facts.append((doc_id, source or "", flags, hashlib.blake2b(raw, digest_size=16).digest()))

    def full(self, words: int, entries: int) -> bool:
        return len(self.places) >= words or self.indptr[-1] >= entries

    def batch(self, number: int) -> pa.RecordBatch:
        facts = pa.StructArray.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(zip(*self.facts), FACTS)], fields=list(FACTS))
        values = (facts, pa.array(list(self.places), pa.binary()), pa.array(self.indptr, pa.int64()),
                  pa.array(np.concatenate(self.columns)), pa.array(np.concatenate(self.counts)))
        lists = [pa.ListArray.from_arrays([0, len(v)], v) for v in values]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *lists], schema=LOCAL)


def shards(docs: DataFrame) -> DataFrame:
    """Documents in shards, counted by the words of the shard's own vocabulary; computed once."""
    ship(docs.sparkSession)
    limits = SHARD_WORDS, SHARD_ENTRIES

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, shard, made = TaskContext.get().partitionId() << 32, Shard(), 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "source", "text"))):
                shard.add(*row)
                if shard.full(*limits):
                    yield shard.batch(first + made)
                    shard, made = Shard(), made + 1
        if shard.facts:
            yield shard.batch(first + made)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), "text")
    return stored(rows.mapInArrow(fill, LOCAL_DDL), "shards")


def code(word: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), word)


def dictionary(local: DataFrame, seed: int) -> DataFrame:
    """Every `column`, and whether all words that it stands for are `alike`."""
    words = local.select(F.explode("vocabulary").alias("word"))
    # told by another 64 bits: aggregates of numbers need no sort
    coded = words.select(code(F.col("word"), seed).alias("column"), code(F.col("word"), ~seed).alias("check"))
    return coded.groupBy("column").agg((F.min("check") == F.max("check")).alias("alike"))


def matrix(docs: DataFrame) -> DataFrame:
    """The document-term matrix: `shard`, `facts`, `vocabulary`, `indptr`, `places`, `counts`, `columns`.

    Row r of a shard has the entries e from `indptr[r]` to `indptr[r + 1]`; entry e says that the
    word of column `columns[places[e]]` occurs `counts[e]` times.
    """
    local, seed = shards(docs), 0
    while dictionary(local, seed).filter("NOT alike").limit(1).count():
        seed += 1
    return local.withColumn("columns", F.transform("vocabulary", lambda w: code(w, seed)))


def failures(made: DataFrame) -> DataFrame:
    """`doc_id`, `part`, words, distinct words, digest and failed filters of every matrix row."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1)
                facts = row.column("facts").flatten()
                indptr = row.column("indptr").flatten().to_numpy()
                counts = row.column("counts").flatten().to_numpy()
                before = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
                words, distinct = np.diff(before[indptr]), np.diff(indptr)
                doc_id, part, flags, digest = facts.flatten()
                failed = flags.to_numpy() | (words < MIN_WORDS) | (
                    (100 * distinct < DISTINCT_SHARE * words).astype(np.int32) << 1)
                yield pa.RecordBatch.from_arrays(
                    [doc_id, part, pa.array(words, pa.int64()), pa.array(distinct, pa.int64()), digest,
                     pa.array(failed, pa.int32())],
                    names=["doc_id", "part", "n_words", "n_distinct", "digest", "failed"])

    ship(made.sparkSession)
    found = made.select("facts", "indptr", "counts").mapInArrow(
        sums, "doc_id long, part string, n_words long, n_distinct long, digest binary, failed int")
    return stored(found, "failures")


def flagged(docs: DataFrame) -> DataFrame:
    """`failures` with repeated texts: bit n of `failed` stands for the n-th filter."""
    rows = failures(matrix(docs))
    texts = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    met = lookup_join(rows, texts.filter("n > 1").drop("n"), ["digest"], spread="doc_id")
    repeated = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    return met.withColumn("failed", F.col("failed").bitwiseOR(repeated.cast("int") * 16)).drop("first_id")


#: Orders, and for each order and step the filters before it and its own, as bits.
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
BEFORE = [sum(1 << FILTERS.index(c) for c in o[:s]) for o in ORDERS for s in range(len(FILTERS))]
OWN = [1 << FILTERS.index(c) for o in ORDERS for c in o]


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of every part, order and step."""
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.coalesce("quality", F.lit(0)) == 1).cast("int")).alias("good"),
        F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("int")).alias("bad"))
    rows = flagged(docs).select("doc_id", "part", "failed")
    met = lookup_join(rows, marks.filter("good + bad > 0"), ["doc_id"])
    counted = met.groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.coalesce("bad", F.lit(0))).alias("bad"))
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "bad")).alias("cells"))
    steps = parts.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(OWN) - 1))).alias("at"))
    steps = steps.withColumns({
        "before": F.get(F.lit(BEFORE), F.col("at")), "own": F.get(F.lit(OWN), F.col("at"))})

    def total(holds, value=lambda c: c["n"]) -> Column:
        return F.aggregate(F.filter("cells", holds), F.lit(0).cast("long"), lambda a, c: a + value(c))

    def fails(c, bits: str) -> Column:
        return c["failed"].bitwiseAND(F.col(bits)) != 0

    def here(c) -> Column:
        return fails(c, "own") & ~fails(c, "before")

    shares = F.lit([0, *(len(ORDERS) // k for k in range(1, len(FILTERS) + 1))])
    return steps.select(
        "part", F.get(F.lit(ORDERS), (F.col("at") / len(FILTERS)).cast("int")).alias("filter_order"),
        (F.col("at") % len(FILTERS) + 1).cast("int").alias("step"),
        total(lambda c: ~fails(c, "own") & ~fails(c, "before")).alias("kept"),
        total(here).alias("removed"),
        total(lambda c: fails(c, "own") & fails(c, "before")).alias("redundant"),
        total(lambda c: c["failed"] == F.col("own")).alias("unique_fails"),
        total(here, lambda c: c["good"]).alias("good_lost"),
        total(here, lambda c: c["bad"]).alias("toxic_lost"),
        # a document that fails k filters is removed by each of them in one k-th of the orders
        total(lambda c: fails(c, "own"),
              lambda c: c["n"] * F.get(shares, F.bit_count(c["failed"]))).alias("shapley"))
