import itertools
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from logloom.llm import decontaminate, simhash
from logloom.llm.components import components
from tests.llm.helpers import AWKWARD, documents, plain


def prose(rng, n):
    return [rng.choice("abcdefghij") + rng.choice("klmnopqrst") + str(rng.randrange(300))
            for _ in range(n)]


def fingerprint(text, words=3):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    runs = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, p in enumerate(prints):
        for j in range(i):
            if (p ^ prints[j]).bit_count() <= radius:
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return [find(i) for i in range(len(prints))]


def test_bit_sliced_comparison_is_exact():
    rng = np.random.default_rng(0)
    for n, wide, radius in ((200, 1, 2), (700, 2, 19), (5, 1, 2), (129, 1, 3), (64, 1, 0)):
        base = rng.integers(0, 1 << 63, (max(1, n // 10), wide), dtype=np.uint64)
        x = base[rng.integers(0, len(base), n)].copy()
        for row in x:
            for bit in rng.integers(0, 64 * wide, rng.integers(0, radius + 2)):
                row[bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
        want = {(i, j) for j in range(n) for i in range(j)
                if np.bitwise_count(x[i] ^ x[j]).sum() <= radius}
        got = {p for i, j in simhash.close_pairs(x, radius)
               for p in zip(i.tolist(), j.tolist(), strict=True)}
        assert got == want


def test_masks_leave_no_pair_out():
    rng = random.Random(1)
    masks = [m for (m,) in simhash.exact_masks(2)]
    for _ in range(2000):
        difference = sum(1 << b for b in rng.sample(range(64), 2))
        assert any(not difference & m for m in masks)


def test_groups_equal_brute_force(spark):
    rng = random.Random(2)
    rows = [*AWKWARD]
    for n in range(40):
        words = prose(rng, rng.choice((2, 9, 60, 400)))
        for copy in range(rng.choice((1, 1, 2, 6))):
            own = [*words]
            if copy % 2:
                own[rng.randrange(len(own))] = "changed"
            rows.append((100 + 10 * n + copy, " ".join(own), "en", "a"))
    docs = documents(spark, rows, clashing=True)
    got = simhash.grouped(docs).collect()
    prints = [fingerprint(r[1]) for r in rows]
    class_of = brute_components(prints, 2)
    least = {}
    for row, c in zip(rows, class_of, strict=True):
        if row[0] is not None:
            least[c] = min(row[0], least.get(c, row[0]))
    want = [(r[0], p, least.get(c)) for r, p, c in zip(rows, prints, class_of, strict=True)]
    assert plain((r.doc_id, r.f0 % (1 << 64), r.component_id) for r in got) == plain(want)
    assert simhash.grouped(docs.limit(0)).collect() == []


def test_large_buckets_are_tiled(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 8)
    rng = np.random.default_rng(3)
    prints = [0]
    for _ in range(120):
        prints.append(prints[rng.integers(len(prints))] ^ (1 << int(rng.integers(12))))
    prints = sorted(set(prints))
    table = spark.createDataFrame([(i, p) for i, p in enumerate(prints)], "rep long, f0 long")
    edges = simhash.links(table, ["f0"], 1, simhash.exact_masks(1))
    found = {r.node: r.component for r in components(edges).collect()}
    assert [found.get(i, i) for i in range(len(prints))] == brute_components(prints, 1)


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 7)] + [(500, 501 + i) for i in range(50)]
    table = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in components(table).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 551)}


def test_one_of_each_group_stays(spark):
    rng = random.Random(5)
    base = prose(rng, 400)
    near = [*base]
    near[17] = "other"
    rows = [(3, " ".join(base), "en", "a"), (1, " ".join(near), "de", "b"), (9, " ".join(base), "en", "a"),
            (9, " ".join(base), "en", "a"), (4, " ".join(prose(rng, 300)), "en", "a"),
            (None, " ".join(base), "en", "a"), (None, " ".join(prose(rng, 80)), "en", "a"),
            (6, " ".join(prose(rng, 90)), "en", "a"), (6, " ".join(prose(rng, 90)), "en", "a")]
    docs = documents(spark, rows, clashing=True)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert plain((r.doc_id, r.text) for r in kept.collect()) == plain(
        [(1, rows[1][1]), (4, rows[4][1]), (None, rows[6][1]), (6, rows[7][1]), (6, rows[8][1])])
    twice = documents(spark, [rows[4], rows[4]])
    assert simhash.keep_one(twice).count() == 1
    assert simhash.keep_one(docs.limit(0)).collect() == []


def shingles(text):
    found = text.lower().split()
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))}


def test_near_copies_are_those_that_share_enough_shingles(spark):
    rng = random.Random(12)
    rows, near, clean = [], set(), set()
    for n in range(400):
        base = prose(rng, 300)
        share = rng.choice((0.6, 0.7, 0.76, 0.79, 0.81, 0.85, 0.9))
        other = base[: round(300 * 2 * share / (1 + share))]
        other += prose(rng, 300 - len(other))
        a, b = shingles(" ".join(base)), shingles(" ".join(other))
        (near if 5 * len(a & b) >= 4 * len(a | b) else clean).add(10 * n + 1)
        rows += [(10 * n, " ".join(base), "en", "a"), (10 * n + 1, " ".join(other), "en", "a")]
    kept = {r.doc_id for r in simhash.keep_one(documents(spark, rows)).collect()}
    assert clean <= kept and {10 * n for n in range(400)} <= kept
    assert len(near & kept) <= 0.03 * len(near)


def test_verified_sets_equal_brute_force():
    rng = random.Random(13)
    sets = []
    for _ in range(30):
        base = rng.sample(range(500), 40)
        sets += [{*rng.sample(base, rng.randint(30, 40))} for _ in range(rng.randint(1, 5))]
    rng.shuffle(sets)
    ends = np.cumsum([0, *map(len, sets)])
    edges = list(simhash.verified(np.array([x for s in sets for x in sorted(s)]), ends))
    assert all(5 * len(sets[x] & sets[y]) >= 4 * len(sets[x] | sets[y]) for x, y in edges)
    root = list(range(len(sets)))
    for _ in sets:
        for x, y in edges:
            root[x] = root[y] = min(root[x], root[y])
    want = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if 5 * len(a & b) >= 4 * len(a | b):
                    want[i] = want[j] = min(want[i], want[j])
    assert root == want


def test_large_candidate_groups_are_tiled(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE_MEMBERS", 5)
    rng = random.Random(14)
    base = prose(rng, 300)
    rows = [(n, " ".join([*base[:n], "other", *base[n + 1 :]]), "en", "a") for n in range(40)]
    assert [r.doc_id for r in simhash.keep_one(documents(spark, rows)).collect()] == [0]


def test_groups_of_several_buckets_are_merged_where_that_is_less(spark):
    groups = [(1, 2, 3), (1, 3, 4), (2, 3, 4), (1, 2, 3, 4), (4, 2),  # 16 pairs of one, 47 of five
              *((10 * n, 10 * n + 10) for n in range(2, 9)),  # a chain: 64 pairs of one, 28 of seven
              (500, 501)]
    rows = [(n, min(g), rep) for n, g in enumerate(groups) for rep in g]
    found = simhash.merged(spark.createDataFrame(rows, "of long, least long, rep long")).collect()
    got = {}
    for r in found:
        got.setdefault(r.of, []).append(r.rep)
    want = [(1, 2, 3, 4), *((10 * n, 10 * n + 10) for n in range(2, 9)), (500, 501)]
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want))
    empty = spark.createDataFrame([], "of long, least long, rep long")
    assert simhash.merged(empty).collect() == []


def test_buckets_of_large_tables_hold_no_more_and_find_as_much():
    recall = []
    for rows in (0, 1, 10**6, 6 * 10**7, 10**9, 10**11):
        bits, tables = simhash.near_tables(rows)
        assert rows / 2**bits <= simhash.TILE
        agree = np.prod([(108 - k) / (128 - k) for k in range(bits)])  # 20 of 128 bits differ
        recall.append(1 - (1 - agree) ** tables)
    assert simhash.near_tables(6 * 10**7) == (simhash.NEAR_BITS, simhash.NEAR_TABLES)
    assert min(recall) > 0.99
    masks = simhash.sampled_masks(2, *simhash.near_tables(10**9))
    assert {sum(m.bit_count() for m in mask) for mask in masks} == {simhash.near_tables(10**9)[0]}


def test_leaks_exact_substituted_partial(spark):
    rng = random.Random(7)
    items = [(i, " ".join(prose(rng, n)).capitalize() + ".") for i, n in enumerate((14, 30, 60, 9))]
    items += [(8, items[1][1]), (9, "too short to tell"), (10, None), (None, "")]
    words = [t.split() for _, t in items[:4]]

    def inside(some):
        return " ".join([*prose(rng, 40), *some, *prose(rng, 40)])

    changed = [*words[1]]
    for place in (4, 11, 19, 25):
        changed[place] = "other"
    docs = [
        (1, inside(words[0]), "en", "a"), (2, inside([w.upper() for w in words[2]]), "en", "a"),
        (3, inside(changed), "en", "a"), (4, inside(words[2][20:36]), "en", "a"),
        (5, inside(words[2][:8]), "en", "a"), (6, inside(prose(rng, 500)), "en", "a"),
        (7, inside(words[3]), "en", "a"), (8, " ".join(words[1][:12]), "en", "a"),
        *AWKWARD]
    table = documents(spark, docs, clashing=True)
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1))
    found = decontaminate.leaks(table, benchmark).collect()
    assert {(r._id, r.item_id) for r in found} == {(1, 0), (2, 2), (3, 1), (4, 2), (7, 3)}
    kept = decontaminate.clean(table, benchmark)
    assert kept.columns == table.columns
    assert kept.count() == table.count() - sum(d[0] in (1, 2, 3, 4, 7) and d not in AWKWARD
                                               for d in docs)
    assert decontaminate.leaks(table, benchmark.limit(0)).collect() == []
    assert decontaminate.clean(table.limit(0), benchmark).collect() == []


def test_blocks_of_the_benchmark_give_the_same(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i, " ".join(prose(rng, 25))) for i in range(30)]
    docs = documents(spark, [(i, " ".join([*prose(rng, 20), t]), "en", "a") for i, t in items[::3]])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = plain(decontaminate.leaks(docs, benchmark).collect())
    monkeypatch.setattr(decontaminate, "KEYS_PER_BLOCK", 400)
    assert plain(decontaminate.leaks(docs, benchmark).collect()) == whole
    assert len(whole) == 10


def accepted(item, words):
    """Whether some alignment of the item with the document agrees enough, by trying all."""
    n, size = len(item), len(words)
    if n < decontaminate.INSIDE:
        return item == words
    need = min(decontaminate.OVERLAP, n)
    for shift in range(-n + 1, size):
        equal = [words[i + shift] == item[i] for i in range(max(0, -shift), min(n, size - shift))]
        if len(equal) >= need and (sum(equal) >= 0.8 * len(equal) or any(
                sum(equal[i : i + need]) >= 0.8 * need for i in range(len(equal) - need + 1))):
            return True
    return False


def test_masks_miss_no_accepted_overlap():
    def hit(length, changed):
        return any(not changed & {at + p for p in mask} for mask in decontaminate.MASKS
                   for at in range(length - mask[-1]))

    for length in range(9, 20):
        for k in range(length // 5 + 1):
            assert all(hit(length, set(c)) for c in itertools.combinations(range(length), k))
    for length in range(20, 45):  # random placements of the most substitutions that 0.8 allows
        rng = random.Random(length)
        assert all(hit(length, set(rng.sample(range(length), length // 5))) for _ in range(300))


def test_leaks_equal_brute_force(spark):
    """Every placement of one in nine, two in ten; short items; random substitutions, cuts and repeats."""
    rng, docs, items = random.Random(3), [], []

    def word(n=400):
        return f"w{rng.randrange(n)}"

    def variant(item, places):
        return [f"x{i}" if i in places else w for i, w in enumerate(item)]

    for n, k in ((9, 1), (10, 2), (5, 1), (8, 1), (8, 0), (4, 0), (4, 1), (3, 0), (1, 0), (15, 3)):
        item = [f"i{n}-{k}-{j}".replace("-", "q") for j in range(n)]
        items.append(item)
        places = list(itertools.combinations(range(n), k))
        for c in places if len(places) < 60 else rng.sample(places, 60):
            docs.append([word() for _ in range(7)] + variant(item, c) + [word() for _ in range(5)])
        docs.append(item)
    for _ in range(60):
        items.append([word(12) for _ in range(rng.randrange(1, 30))])
    for _ in range(120):
        item = rng.choice(items)
        at = rng.randrange(len(item))
        part = variant(item[at : at + rng.randrange(8, 30)], {j for j in range(30) if rng.random() < 0.15})
        docs.append([word(12) for _ in range(rng.randrange(6))] + part + [word(12) for _ in range(rng.randrange(6))])
    items += [["same"] * 6, ["same"] * 20]
    docs += [["same"] * 5, ["same"] * 12, ["same"] * 40, ["a", "same"] * 9, []]
    table = documents(spark, [(i, " ".join(d), "en", "a") for i, d in enumerate(docs)])
    benchmark = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(items)], "item_id long, text string")
    first = {}
    for i, d in enumerate(items):
        first.setdefault(tuple(d), i)
    want = {(i, n) for i, d in enumerate(docs) for item, n in first.items() if accepted(list(item), d)}
    got = [(r._id, r.item_id) for r in decontaminate.leaks(table, benchmark).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert len({i for i, n in want if n == 0}) == 10 and len({i for i, n in want if n == 1}) == 46


def test_leaks_of_one_word_repeated(spark):
    docs = documents(spark, [(1, "word " * 20_000, "en", "a"), (2, "other " * 50, "en", "a"), (2, "word " * 20_000, "en", "a")])
    benchmark = spark.createDataFrame([(1, "word " * 60), (2, "word " * 5)], "item_id long, text string")
    found = decontaminate.leaks(docs, benchmark).collect()
    assert sorted((r._id, r.item_id, r.equal_words) for r in found) == [(1, 1, 60), (1, 2, 5), (2, 1, 60), (2, 2, 5)]
