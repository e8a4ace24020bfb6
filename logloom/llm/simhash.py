"""SimHash near-duplicates by bit-sliced comparison.

A fingerprint bit is set if it is set in more than half of the hashes of a text's word shingles.
Fingerprints meet in buckets: for a radius of r in 64 bits, the word is cut into r + 2 blocks, and
two fingerprints within r differ in at most r of them, so they agree in some pair of blocks. That
is exact. For wider fingerprints and large radii, buckets come from random samples of bits.

Within a bucket the fingerprints are stored as bit planes (one machine word holds the same bit of
64 fingerprints). One fingerprint is compared with 64 others at once: each plane's differences are
added to carry-save counters, bit by bit of the count, and words in which all 64 already exceed
the radius are abandoned. Buckets of more than `TILE` fingerprints are cut into tiles and every
two tiles meet in a task of their own. A bucket passes on a spanning forest of its links only.

Equal fingerprints are one row before anything is compared, so groups of copies cost nothing.

For keeping one of several near copies the fingerprints only propose: documents that hang together
within a bucket are compared by their sets of shingles, and only a pair that shares 0.8 of its
union is linked. Groups of several buckets that share members are compared as one where that
makes no more pairs. Documents with equal sets are one row, and each pass over a group compares one
member with those not yet reached, so a group of near copies costs about one pass.

Defined cases: NULL and empty texts have fingerprint zero, linked like any other. A text with
fewer words than a shingle is one shingle. Rows without an id link like others but name no
component; a class of such rows only has a NULL one. Rows that share an id are separate documents.
Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import minus, packed, same_row, ship, stored
from logloom.llm.components import components
from logloom.operators.lookup import lookup_join

SEEDS = (42,)
WORDS = 3
RADIUS = 2
TILE = 4096
PLANES_AT_ONCE = 8
WORDS_AT_ONCE = 8192


def shingle_hashes(text: str, words: int, seed: int) -> np.ndarray:
    """XXH64 of every shingle of `words` words joined by single spaces; A-Z are lower-cased."""
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], dtype=np.uint64)
    sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = starts + sizes
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(joined[a:b], seed) for a, b in
         zip(starts[: 1 - words].tolist(), ends[words - 1 :].tolist(), strict=True)],
        dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes; none give zero."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, dtype=np.int64)
    for low in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[low : low + (1 << 16)].astype("<u8").view(np.uint8)
                             .reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(packed.view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, seeds: tuple = SEEDS) -> DataFrame:
    """`doc_id, _text` and one signed 64-bit column f0, f1, ... for each seed."""
    ship(docs.sparkSession)
    names = [f"f{i}" for i in range(len(seeds))]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array(
                [[fingerprint(shingle_hashes(t.as_py() or "", words, s)) for s in seeds]
                 for t in batch["text"]], dtype=np.uint64).reshape(-1, len(seeds))
            yield pa.record_batch(
                {"doc_id": batch["doc_id"], "_text": batch["_text"]}
                | {n: pa.array(found[:, i].view(np.int64)) for i, n in enumerate(names)})

    kind = ", ".join(["doc_id long", "_text long", *(f"{n} long" for n in names)])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("_text"), "text")
    return rows.mapInArrow(compute, kind)


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def exact_masks(radius: int) -> list[tuple[int]]:
    """Masks of 64 bits such that two words within the radius agree on at least one of them."""
    blocks = radius + 2
    edges = [64 * i // blocks for i in range(blocks + 1)]
    part = [((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in range(blocks)]
    return [(part[i] | part[j],) for i, j in itertools.combinations(range(blocks), 2)]


def sampled_masks(n_words: int, bits: int, tables: int, seed: int = 5) -> list[tuple]:
    """`tables` random choices of `bits` bits among the fingerprints' 64 * `n_words`."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(tables):
        masks = [0] * n_words
        for bit in rng.choice(64 * n_words, bits, replace=False).tolist():
            masks[bit // 64] |= 1 << (bit % 64)
        out.append(tuple(masks))
    return out


def planes_of(prints: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of all fingerprints, 64 to a word; short words are padded."""
    n, wide = prints.shape
    lanes = -(-n // 64)
    padded = np.zeros((lanes * 64, wide), dtype="<u8")
    padded[:n] = prints
    bits = np.unpackbits(padded.view(np.uint8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def close_pairs(prints: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) with i < j of all fingerprints within the radius, some at a time."""
    planes = planes_of(prints)
    n = len(prints)
    lanes = planes.shape[1]
    counters = max(1, int(radius + 1).bit_length())
    start = (1 << counters) - radius - 1  # the counter overflows at the first bit too many
    one = np.uint64(0xFFFFFFFFFFFFFFFF)
    set_in = np.bitwise_count(planes).sum(axis=1, dtype=np.int64)
    mixed = np.flatnonzero((set_in > 0) & (set_in < n))  # the others never differ
    step = max(1, 200_000 // lanes)
    for low in range(0, n, step):
        high = min(n, low + step)
        query, lane = np.divmod(np.arange((high - low) * lanes), lanes)
        query += low
        after = lane * 64 + 63 > query
        query, lane = query[after], lane[after]
        sums = [np.full(len(query), one if start >> k & 1 else 0, dtype=np.uint64)
                for k in range(counters)]
        over = np.zeros(len(query), dtype=np.uint64)
        for first in range(0, len(mixed), PLANES_AT_ONCE):
            for bit in mixed[first : first + PLANES_AT_ONCE]:
                own = (prints[query, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)
                carry = planes[bit][lane] ^ (own * one)
                for k in range(counters):
                    sums[k], carry = sums[k] ^ carry, sums[k] & carry
                over |= carry
            alive = over != one
            if not alive.all():
                query, lane, over = query[alive], lane[alive], over[alive]
                sums = [s[alive] for s in sums]
            if not len(query):
                break
        # where all pairs are close a word has 64 of them, so few words are spelled out at once
        for at in range(0, len(query), WORDS_AT_ONCE):
            part = slice(at, at + WORDS_AT_ONCE)
            near = np.unpackbits((~over[part]).view(np.uint8).reshape(-1, 8), axis=1,
                                 bitorder="little")
            row, bit = np.nonzero(near)
            i, j = query[part][row], lane[part][row] * 64 + bit
            good = (j > i) & (j < n)
            if good.any():
                yield i[good], j[good]


def forest(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) of every fingerprint that hangs together with an earlier one."""
    root = np.arange(len(prints))
    for i, j in close_pairs(prints, radius):
        while True:
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                break
            np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
            while (root[root] != root).any():
                root = root[root]
    member = np.flatnonzero(root != np.arange(len(prints)))
    return member, root[member]


def meetings(prints: DataFrame, names: list[str], masks: list[tuple]) -> DataFrame:
    """`all`: the fingerprints of each bucket, or of each two tiles of a large one."""
    keys = F.explode(F.array(*(
        F.struct(F.lit(t).alias("t"), *(
            F.col(n).bitwiseAND(F.lit(signed(m)).cast("long")).alias(f"k{i}")
            for i, (n, m) in enumerate(zip(names, mask, strict=True))))
        for t, mask in enumerate(masks))))
    rows = prints.select("rep", *names, keys.alias("k")).select(
        "rep", *names, F.xxhash64(*(f"k.{c}" for c in ["t", *(f"k{i}" for i in range(len(names)))])
                                  ).alias("bucket"))
    large = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > TILE)
    large = large.select(F.col("bucket").alias("of"), F.ceil(F.col("n") / TILE).alias("cuts"))
    rows = rows.join(large, F.col("bucket") == F.col("of"), "left")
    cuts = F.coalesce(F.col("cuts"), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64(*names, F.lit(1)), cuts).cast("int")
    meet = F.transform(F.sequence(F.lit(0), cuts - 1), lambda other: F.struct(
        F.least(own, other).alias("x"), F.greatest(own, other).alias("y")))
    rows = rows.withColumn("tile", F.explode(meet)).select("bucket", "tile", "rep", *names)
    return rows.groupBy("bucket", "tile").agg(
        F.collect_list(F.struct("rep", *names)).alias("all")).filter(F.size("all") > 1).select("all")


def met(column: pa.Array, names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(reps, fingerprints, offsets) of a batch of `meetings`."""
    flat = column.flatten()
    bits = np.stack([flat.field(n).to_numpy().view(np.uint64) for n in names], axis=1)
    return flat.field("rep").to_numpy(), bits, column.offsets.to_numpy() - column.offsets[0].as_py()


def links(prints: DataFrame, names: list[str], radius: int, masks: list[tuple]) -> DataFrame:
    """Edges (a, b) between the `rep` of fingerprints, enough to connect all within the radius."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            reps, bits, offsets = met(batch["all"], names)
            sizes = np.diff(offsets)
            for size in np.unique(sizes[sizes <= 4]):
                at = offsets[:-1][sizes == size]
                for i, j in itertools.combinations(range(int(size)), 2):
                    x, y = at + i, at + j
                    near = np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1) <= radius
                    found.append(np.stack([reps[x[near]], reps[y[near]]], axis=1))
            for n in np.flatnonzero(sizes > 4):
                own = slice(int(offsets[n]), int(offsets[n + 1]))
                member, root = forest(bits[own], radius)
                found.append(np.stack([reps[own][member], reps[own][root]], axis=1))
            edges = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)
            yield pa.record_batch({"a": pa.array(edges[:, 0]), "b": pa.array(edges[:, 1])})

    return meetings(prints, names, masks).mapInArrow(compare, "a long, b long")


def grouped(
    docs: DataFrame, words: int = WORDS, seeds: tuple = SEEDS, radius: int = RADIUS,
    masks: list[tuple] | None = None,
) -> DataFrame:
    """`doc_id, _text`, fingerprints, `class` and `component_id` (its least id) of every document.

    Without `masks` there is one seed and the buckets are exact for the radius.
    """
    names = [f"f{i}" for i in range(len(seeds))]
    masks = masks or exact_masks(radius)
    rows = stored(fingerprints(docs, words, seeds), "prints")
    # a fingerprint's own number: itself, or a hash of its words
    node = F.col(names[0]) if len(names) == 1 else F.xxhash64(*names)
    reps = stored(rows.groupBy(*names).agg(F.min("doc_id").alias("least")).withColumn(
        "rep", node), "reps")
    found = components(links(reps, names, radius, masks))
    reps = reps.join(found, F.col("rep") == F.col("node"), "left").select(
        *(F.col(n).alias(f"r{n}") for n in names), "least",
        F.coalesce("component", "rep").alias("class"))
    ids = reps.groupBy("class").agg(F.min("least").alias("component_id"))
    reps = reps.join(ids, "class")
    on = F.lit(True)
    for n in names:
        on = on & (F.col(n) == F.col(f"r{n}"))
    return rows.join(reps, on).select("doc_id", "_text", *names, "class", "component_id")


#: For keeping one of several near copies: five-word shingles and 128 bits. Shingle sets that share
#: 0.8 of their union differ in 19 or 20 bits on average, in over `NEAR_RADIUS` once in a thousand.
NEAR_WORDS = 5
NEAR_SEEDS = (42, 43)
NEAR_RADIUS = 32
NEAR_BITS = 14
NEAR_TABLES = 64
#: Of the 128 bits, those in which sets at the threshold differ; tables of more bits keep its recall.
NEAR_APART = 20
#: Shared part of the union of two shingle sets that are near copies, as a fraction.
NEAR_SHARE = (4, 5)
#: Fingerprints that are compared each with each, without bit planes.
FEW = 192
#: Shingles and members of a candidate group that one task holds of it, twice.
TILE_SHINGLES = 1_000_000
TILE_MEMBERS = 2048


def near_tables(rows: int) -> tuple[int, int]:
    """Sampled bits and number of tables for so many fingerprints.

    A bucket holds at most `TILE` unrelated ones on average, so a row is compared with no more
    however large the table is. Each further bit is agreed on less often by near copies, which as
    many more tables make up for.
    """
    bits, wide = max(NEAR_BITS, math.ceil(math.log2(max(rows, 1) / TILE))), 64 * len(NEAR_SEEDS)
    more = math.prod((wide - k) / (wide - NEAR_APART - k) for k in range(NEAR_BITS, bits))
    return bits, math.ceil(NEAR_TABLES * more)


def shingle_set(text: str | None, words: int, seed: int) -> np.ndarray:
    return np.unique(shingle_hashes(text or "", words, seed))


def near_prints(docs: DataFrame) -> DataFrame:
    """`doc_id, _text`, `rep` (digest of the shingle set), its `size`, and f0, f1 of the set."""
    ship(docs.sparkSession)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[], [], [], []]
            for text in batch["text"]:
                own = shingle_set(text.as_py(), NEAR_WORDS, NEAR_SEEDS[0])
                found[0].append(xxhash.xxh64_intdigest(own.tobytes()))
                found[1].append(len(own))
                found[2].append(fingerprint(own))
                found[3].append(fingerprint(shingle_set(text.as_py(), NEAR_WORDS, NEAR_SEEDS[1])))
            columns = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in found]
            yield pa.record_batch({"doc_id": batch["doc_id"], "_text": batch["_text"]}
                                  | dict(zip(("rep", "size", "f0", "f1"), columns, strict=True)))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("_text"), "text")
    return rows.mapInArrow(
        compute, "doc_id long, _text long, rep long, size long, f0 long, f1 long")


def close_forest(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """`forest`, for few fingerprints by comparing all at once."""
    if len(prints) > FEW:
        return forest(prints, radius)
    apart = np.bitwise_count(prints[:, None, 0] ^ prints[None, :, 0])
    for k in range(1, prints.shape[1]):
        apart = apart + np.bitwise_count(prints[:, None, k] ^ prints[None, :, k])
    near = apart <= radius
    root = np.arange(len(prints))
    if np.count_nonzero(near) > len(prints):
        while True:
            least = np.where(near, root[None, :], len(prints)).min(axis=1)
            if (least == root).all():
                break
            root = least
    member = np.flatnonzero(root != np.arange(len(prints)))
    return member, root[member]


def candidates(prints: DataFrame, names: list[str], radius: int, masks: list[tuple]) -> DataFrame:
    """`of, least, rep`: fingerprints that hang together within a bucket, each such group once.

    `of` names the group, `least` is its smallest member.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, bits, offsets = met(batch["all"], names)
            groups = []
            sizes = np.diff(offsets)
            at = offsets[:-1][sizes == 2]
            near = np.bitwise_count(bits[at] ^ bits[at + 1]).sum(axis=1) <= radius
            groups += [reps[x : x + 2] for x in at[near].tolist()]
            for n in np.flatnonzero(sizes > 2):
                own = slice(int(offsets[n]), int(offsets[n + 1]))
                member, root = close_forest(bits[own], radius)
                order = np.argsort(root, kind="stable")
                member, root = member[order], root[order]
                cut = np.flatnonzero(np.diff(root)) + 1
                if len(root):
                    firsts = root[np.concatenate([[0], cut])]
                    groups += [reps[own][np.append(m, r)]
                               for m, r in zip(np.split(member, cut), firsts, strict=True)]
            groups = [np.sort(g) for g in groups]
            names_of = np.array([xxhash.xxh64_intdigest(g.tobytes()) for g in groups], dtype=np.uint64)
            firsts_of = np.array([g[0] for g in groups], dtype=np.int64)
            many = [len(g) for g in groups]
            yield pa.record_batch({
                "of": pa.array(np.repeat(names_of, many).view(np.int64)),
                "least": pa.array(np.repeat(firsts_of, many)),
                "rep": pa.array(np.concatenate(groups) if groups else np.zeros(0, dtype=np.int64))})

    return meetings(prints, names, masks).mapInArrow(
        compare, "of long, least long, rep long").distinct()


def merged(found: DataFrame) -> DataFrame:
    """`of, rep`: the groups whose members are compared; each group of `candidates` is within one.

    The buckets see a group of near copies up to 64 times, each time with other members missing.
    All that hangs together over the buckets is one group, and each member there once, if that
    makes no more pairs than its buckets' groups make together; others stay as they are.
    """
    # a member ties the least ones of its groups, at most one a bucket, to each other: few edges
    ties = found.groupBy("rep").agg(F.min("least").alias("a"), F.collect_set("least").alias("all"))
    ties = ties.select("a", F.explode(F.array_union("all", F.array("rep"))).alias("b")).distinct()
    belongs = stored(components(ties), "belongs")
    groups = found.groupBy("of", "least").agg(F.count(F.lit(1)).cast("double").alias("n"))
    groups = stored(groups.join(belongs, F.col("least") == F.col("node")).select(
        "of", "component", "n"), "groups")
    one = belongs.groupBy("component").agg(F.count(F.lit(1)).cast("double").alias("n"))
    apart = groups.groupBy("component").agg(F.sum(F.col("n") * F.col("n")).alias("pairs"))
    whole = stored(one.join(apart, "component").filter(F.col("n") * F.col("n") <= F.col("pairs")).select(
        "component"), "whole")
    together = lookup_join(belongs, whole, ["component"], "left_semi", spread="node", settled=True)
    others = stored(lookup_join(groups, whole, ["component"], "left_anti", spread="of", settled=True)
                    .select("of"), "others")
    single = lookup_join(found, others, ["of"], "left_semi", spread="rep", settled=True)
    return together.select(F.xxhash64("component", F.lit("whole")).alias("of"),
                           F.col("node").alias("rep")).unionByName(single.select("of", "rep"))


def verified(ids: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges that connect all sets with a chain of pairs sharing `NEAR_SHARE` of their union.

    Set i is `ids[ends[i]:ends[i + 1]]`, no value twice; none is empty. Every pair that is not
    connected by others is compared.
    """
    part, whole = NEAR_SHARE
    values, ids = np.unique(ids, return_inverse=True)
    sizes = np.diff(ends)
    mine = np.zeros(len(values), dtype=bool)
    left, queue = np.arange(len(sizes)), []
    rest, starts = ids, ends[:-1]
    while len(left):
        x = queue.pop() if queue else int(left[-1])
        own = ids[ends[x] : ends[x + 1]]
        mine[own] = True
        shared = np.add.reduceat(mine[rest], starts, dtype=np.int64)
        mine[own] = False
        good = whole * shared >= part * (sizes[x] + sizes[left] - shared)
        for y in left[good].tolist():
            if y != x:
                queue.append(y)
                yield x, y
        if good.any():
            rest = rest[np.repeat(~good, sizes[left])]
            left = left[~good]
            starts = np.cumsum(sizes[left]) - sizes[left]


def near_links(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Edges (a, b) between the `rep` of candidates whose shingle sets are near copies."""
    names = [f"f{i}" for i in range(len(NEAR_SEEDS))]
    # one document, with an id if there is one, stands for those with equal sets
    some = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_text"))
    reps = stored(rows.filter("size > 0").groupBy("rep", "size", *names).agg(
        some.alias("one")), "reps")
    masks = sampled_masks(len(NEAR_SEEDS), *near_tables(reps.count()))
    found = stored(candidates(reps, names, NEAR_RADIUS, masks), "candidates")
    wanted = reps.join(found.select("rep").distinct(), "rep", "left_semi").select(
        F.col("one.doc_id").alias("_id"), F.col("one._text").alias("_text"), "rep")
    texts = packed(docs.select("doc_id", "text")).join(wanted, same_row()).select(
        "rep", F.col("_row.text").alias("text"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), NEAR_WORDS, NEAR_SEEDS[0]).view(np.int64)
                    for t in batch["text"]]
            yield pa.record_batch({"rep": batch["rep"], "shingles": pa.array(
                sets, type=pa.list_(pa.int64()))})

    sets = texts.mapInArrow(split, "rep long, shingles array<long>").dropDuplicates(["rep"])
    members = stored(merged(found), "members").join(reps.select("rep", "size"), "rep")
    cuts = F.greatest(F.ceil(F.sum("size") / TILE_SHINGLES), F.ceil(F.count("rep") / TILE_MEMBERS))
    large = members.groupBy("of").agg(cuts.cast("int").alias("cuts")).filter("cuts > 1")
    members = members.join(large, "of", "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    own = F.pmod(F.xxhash64("rep", F.lit(2)), F.col("cuts")).cast("int")
    # a tile of two parts also compares each part with itself, so no part has a tile of its own
    others = F.filter(F.sequence(F.lit(0), F.col("cuts") - 1),
                      lambda other: (other != own) | (F.col("cuts") == 1))
    meet = F.transform(others, lambda other: F.struct(
        F.least(own, other).alias("x"), F.greatest(own, other).alias("y")))
    members = members.withColumn("tile", F.explode(meet)).select("of", "tile", "rep")
    groups = members.join(sets, "rep").groupBy("of", "tile").agg(
        F.collect_list(F.struct("rep", "shingles")).alias("all")).filter(F.size("all") > 1)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = []
            for group in batch["all"]:
                flat = group.values
                reps, lists = flat.field("rep").to_numpy(), flat.field("shingles")
                ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
                edges += [(reps[x], reps[y]) for x, y in verified(lists.flatten().to_numpy(), ends)]
            both = np.array(edges, dtype=np.int64).reshape(-1, 2)
            yield pa.record_batch({"a": pa.array(both[:, 0]), "b": pa.array(both[:, 1])})

    return groups.select("all").mapInArrow(compare, "a long, b long")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id, as it is.

    A row without an id stays only if no copy of it has one.
    """
    rows = stored(near_prints(docs), "prints")
    found = components(near_links(docs, rows))
    rows = stored(rows.join(found, F.col("rep") == F.col("node"), "left").select(
        F.col("doc_id").alias("_id"), "_text", F.coalesce("component", "rep").alias("class")), "groups")
    own = F.struct(F.col("_id").isNull(), "_id", "_text")
    first = rows.groupBy("class").agg(F.min(own).alias("first"))
    first = first.select("class", "first._id", "first._text")
    # all three columns are keys, so the rows of one class meet in no task
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ("class", "_id", "_text")]
    gone = rows.alias("r").join(first.alias("s"), same, "left_anti").select("_id", "_text")
    twice = rows.groupBy("_id", "_text").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if twice.isEmpty():
        return minus(docs, gone)
    again = packed(docs).join(twice.select("_id", "_text"), same_row(), "left_semi")
    again = again.dropDuplicates(["_own_id", "_own_text"]).select("_row.*")
    return minus(docs, gone.unionByName(twice.select("_id", "_text"))).unionByName(
        minus(again, gone))
