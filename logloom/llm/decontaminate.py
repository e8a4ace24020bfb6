"""Benchmark decontamination by spaced-seed hashing.

A mask selects some positions of a window of words; the hash of the selected words is a key, so
a substituted word at an ignored position does not hide a match. Keys of all benchmark windows
meet keys of all training windows; each hit aligns a document with an item, and each different
alignment is verified once, word by word. Columns and joins only.

The masks miss nothing that the verification accepts. Any ten words with two substitutions and any
nine with one hold a mask's place without a substitution; and an overlap of ten or more words that
agrees in 0.8 of them has ten such words or five equal ones in a row. Items of four to eight words
have a key for each word that may differ (from five words on), or for all of them.

The benchmark is the stated query set: it is cut into blocks whose keys have a fixed bound, and
each block is broadcast. Documents do not move; only alignments and verified overlaps do.

Defined cases: words are runs of letters and digits in lower case. NULL and empty texts have no
window. Items without a word are left out; items of one to three words match only a text that has
no other words, for within a text they cannot be told from chance. Repeated items count once, under
their smallest id; a repeated document is reported by its id. A word repeated many times aligns an item with
a document at many shifts, which are compared in groups of bounded length. Empty tables give an
empty result. Other columns of either table are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.once import let, once
from logloom.llm.common import minus
from logloom.operators.lookup import lookup_join

#: Selected positions of each mask.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5), (0, 1, 3, 6, 7))
#: Items with fewer words are keyed as wholes, below `INSIDE` words only as whole texts.
LONG, INSIDE = 9, 4
OVERLAP = 13
SHARE = 0.8
KEYS_PER_BLOCK = 600_000
#: Alignments of a text that are verified as one row begin within so many words.
SHIFTS_PER_ROW = 8192


def word_hashes(text: Column) -> Column:
    parts = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"),
                     lambda x: x != "")
    return F.transform(parts, lambda x: F.xxhash64(x))


def _keys_at(words: Column, at: Column, positions: tuple[int, ...], span: int, name: str) -> Column:
    key = F.xxhash64(F.lit(name), *(F.get(words, at + p) for p in positions))
    return F.when(at + span <= F.size(words), key)


def mask_keys(words: Column, at: Column) -> list[Column]:
    return [_keys_at(words, at, mask, mask[-1] + 1, f"mask{m}") for m, mask in enumerate(MASKS)]


def whole_keys(words: Column, at: Column, n: int) -> list[Column]:
    """Keys of the `n` words from `at` on: without each one of them that may differ."""
    every = tuple(range(n))
    if n < INSIDE:
        return [F.when(F.size(words) == n, _keys_at(words, at, every, n, f"text{n}"))]
    if n * SHARE > n - 1:
        return [_keys_at(words, at, every, n, f"item{n}")]
    return [_keys_at(words, at, every[:j] + every[j + 1 :], n, f"item{n}-{j}") for j in every]


def windows(rows: DataFrame, words: str, keys) -> DataFrame:
    """One row for each position `at` (0-based) and `key`, beside the columns of `rows`."""
    at = F.explode(F.sequence(F.lit(0), F.size(words) - 1)).alias("at")
    placed = rows.filter(F.size(words) > 0).select("*", at)
    # no filter of the array here: it would copy the words for every position
    return placed.select("*", F.explode(F.array(*keys(F.col(words), F.col("at")))).alias("key")).filter(
        "key IS NOT NULL")


def items_of(benchmark: DataFrame) -> DataFrame:
    """Distinct items: `item_id`, `item_words`, their number `n` and a hash `item`."""
    found = (
        benchmark.select(F.col("item_id"), word_hashes(F.col("text")).alias("item_words"))
        .filter(F.size("item_words") > 0)
        .groupBy("item_words").agg(F.min("item_id").alias("item_id"))
    )
    return found.select("item_id", "item_words", F.size("item_words").alias("n"),
                        F.xxhash64("item_words").alias("item"))


def item_keys(items: DataFrame, lengths: list[int]) -> DataFrame:
    """`item_key`, `item`, `n`, `item_at` of all items; `lengths` are those of short items."""
    found = windows(items.filter(F.col("n") >= LONG), "item_words", mask_keys)
    for n in lengths:
        own = items.filter(F.col("n") == n)
        found = found.unionByName(windows(
            own, "item_words", lambda w, at, n=n: [F.when(at == 0, k) for k in whole_keys(w, at, n)]))
    return found.select(F.col("key").alias("item_key"), "item", "n", F.col("at").alias("item_at")).distinct()


def equal_words(item: Column, piece: Column, shift: Column) -> Column:
    """1 or 0 for each word of the item that lies within the document; `piece` holds the document's
    words from the first of them on."""
    first = F.greatest(F.lit(0), -shift)
    return F.zip_with(F.slice(item, first + 1, F.size(piece)), piece,
                      lambda a, b: F.when(a == b, 1).otherwise(0))


def best_window(equal: Column, length: Column) -> Column:
    """The most equal words in any `length` neighbouring ones."""
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"), F.lit(0).alias("i"))

    def step(s, x):
        out = F.when(s["i"] >= length, F.get(equal, s["i"] - length)).otherwise(0)
        now = s["now"] + x - out
        return F.struct(now.alias("now"), F.greatest(s["best"], now).alias("best"),
                        (s["i"] + 1).alias("i"))

    return F.aggregate(equal, start, step)["best"]


def overlap_of(item: Column, piece: Column, shift: Column) -> Column:
    """(verified, equal, length) of the aligned overlap.

    Verified: the whole overlap, or some `OVERLAP` words of it (all words of a shorter item),
    agree in at least `SHARE` of the places.
    """
    need = F.least(F.lit(OVERLAP), F.size(item))

    def decide(equal):
        total = F.aggregate(equal, F.lit(0), lambda a, x: a + x)
        enough = F.size(equal) >= need
        good = F.when(enough & (total >= SHARE * F.size(equal)), True).otherwise(
            enough & (best_window(equal, need) >= SHARE * need))
        return F.struct(good.alias("verified"), total.alias("equal"),
                        F.size(equal).alias("length"))

    return let(equal_words(item, piece, shift), decide)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Verified overlaps: `_id`, `_text` of the document, `item_id`, equal words and length."""
    items = items_of(benchmark)
    n_keys = items.agg(F.sum(F.col("n") * len(MASKS))).first()[0] or 0
    n_blocks = int(n_keys // KEYS_PER_BLOCK) + 1
    short = items.filter(F.col("n") < LONG).select("n").distinct()
    lengths = sorted(r.n for r in short.collect())  # at most LONG - 1
    rows = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_text"), "text")
    texts = once(rows, words=word_hashes(F.col("text"))).select("_text", "words")

    # one pass for the masks, one for each length of short items that there is
    passes = [mask_keys, *((lambda words, at, n=n: whole_keys(words, at, n)) for n in lengths)]
    found = None
    for block in range(n_blocks):
        own = items.filter(F.pmod("item", F.lit(n_blocks)) == block)
        known = F.broadcast(item_keys(own, lengths))
        shift = (F.col("at") - F.col("item_at")).alias("shift")
        met = [windows(texts, "words", keys).join(known, F.col("key") == F.col("item_key")).select(
            "_text", "item", "n", shift) for keys in passes]
        # one row for each different alignment, however many keys say so
        places = reduce(DataFrame.unionByName, met).distinct()
        spots = places.groupBy("_text", F.floor(F.col("shift") / SHIFTS_PER_ROW).alias("part")).agg(
            F.collect_list(F.struct("item", "n", "shift")).alias("spots"))
        near = once(lookup_join(rows, spots.drop("part"), ["_text"], "inner", spread="_id"),
                    words=word_hashes(F.col("text")))
        pieces = F.transform("spots", lambda s: F.struct(
            s["item"].alias("spot"), s["shift"].alias("shift"),
            F.slice(F.col("words"), F.greatest(F.lit(0), s["shift"]) + 1,
                    s["n"] - F.greatest(F.lit(0), -s["shift"])).alias("piece")))
        lists = own.select("item", "item_id", "item_words")
        seen = near.select("_id", "_text", F.inline(pieces)).join(
            F.broadcast(lists), F.col("spot") == F.col("item"))
        seen = seen.select("_id", "_text", "item_id", F.inline(F.array(overlap_of(
            F.col("item_words"), F.col("piece"), F.col("shift"))))).filter("verified")
        found = seen if found is None else found.unionByName(seen)
    return found.groupBy("_id", "_text", "item_id").agg(
        F.max(F.struct("equal", "length")).alias("best")
    ).select("_id", "_text", "item_id", F.col("best.equal").cast("long").alias("equal_words"),
             F.col("best.length").cast("long").alias("overlap_words"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a verified overlap, with their own columns."""
    return minus(docs, leaks(docs, benchmark))
