"""Blocked Bloom filters of stored files, as rows of a small index table.

An index row is one block of one file: (`group`, `file`, `blocks`, `block`, `bits`). A file has a
power of two of blocks, by the number of its items; an item sets its bits within one block, so a
lookup joins on (group, blocks, block) and tests the bits there. An item that is in a file is
always found; one that is not is found with a probability of about half a percent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.operators.lookup import lookup_join
from logloom.session import settle

BLOCK_BITS = 8 * 4096
#: 13 bits an item and `PROBES` bits set.
ITEMS_PER_BLOCK = 2500
PROBES = 6


def _block(item: Column, blocks: Column) -> Column:
    return F.xxhash64(item).bitwiseAND(blocks - 1)


def _positions(item: Column) -> Column:
    """Places of an item's bits in its block: steps of an odd width from a hashed start."""
    start, step = F.xxhash64(F.lit(1), item), F.xxhash64(F.lit(2), item).bitwiseOR(F.lit(1))
    # both below the block's size, so that the products stay small
    start, step = (F.pmod(x, F.lit(BLOCK_BITS)) for x in (start, step))
    return F.array(*(F.pmod(start + n * step, F.lit(BLOCK_BITS)) for n in range(PROBES)))


def _has(bits: Column, position: Column) -> Column:
    byte = F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (position % 8).cast("int")) == 1


def stored_file() -> Column:
    """The file a stored row is read from, as a path to read it by; metadata have it encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def numbered(files: DataFrame) -> DataFrame:
    """(`file`, `number`) of different files: rows by item carry the number, not the path."""
    return settle(files.select("file").distinct().withColumn("number", F.monotonically_increasing_id()))


def index_of(items: DataFrame) -> DataFrame:
    """Index of `items` (group, file, item); NULL items are left out. `file` may be its number."""
    items = settle(items.filter("item IS NOT NULL").select("group", "file", "item").distinct())
    need = F.ceil(F.log2(F.greatest(F.count(F.lit(1)) / ITEMS_PER_BLOCK, F.lit(1.0))))
    sizes = items.groupBy("group", "file").agg(F.pow(F.lit(2.0), need).cast("long").alias("blocks"))
    sized = lookup_join(items, sizes, ["group", "file"], spread="item")
    placed = sized.select(
        "group", "file", "blocks", _block(F.col("item"), F.col("blocks")).alias("block"),
        F.explode(_positions(F.col("item"))).alias("at"))
    return placed.groupBy("group", "file", "blocks", "block").agg(
        F.bitmap_construct_agg("at").alias("bits"))


def lookups(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """(`file`, `item`): files of `index` that may hold an item of `wanted` (group, item)."""
    kinds = [r.blocks for r in index.select("blocks").distinct().collect()]  # powers of two
    if not kinds:
        return wanted.select(F.lit("").alias("file"), "item").limit(0)
    asked = wanted.filter("item IS NOT NULL").select(
        "group", "item", F.explode(F.lit(kinds).cast("array<long>")).alias("blocks")).distinct()
    asked = asked.withColumn("block", _block(F.col("item"), F.col("blocks")))
    met = index.join(asked, ["group", "blocks", "block"])
    return met.filter(F.forall(_positions(F.col("item")), lambda p: _has(F.col("bits"), p))).select("file", "item")


def files_with_any(index: DataFrame, wanted: DataFrame) -> list[str]:
    """Files that may hold at least one wanted item of their group; at most the index's files."""
    return sorted(r.file for r in lookups(index, wanted).select("file").distinct().collect())


def files_with_all(index: DataFrame, wanted: DataFrame) -> list[str]:
    """Files that may hold every wanted item; `wanted` is a short list of different items."""
    n = wanted.select("item").distinct().count()
    found = lookups(index, wanted).groupBy("file").agg(F.count_distinct("item").alias("n"))
    return sorted(r.file for r in found.filter(F.col("n") == n).collect())
