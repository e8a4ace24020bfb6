import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from logloom.llm import langid, mixing, outliers
from logloom.llm.common import table
from tests.conftest import TESTDATA
from tests.llm.helpers import AWKWARD, documents, plain

SPACE = " \t\n\x0b\f\r"


def words_of(text):
    out = [""]
    for c in text or "":
        if c in SPACE:
            out.append("")
        else:
            out[-1] += c
    return [w for w in out if w]


def statistics(text):
    text = text or ""
    words = words_of(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words_of(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def transformed(s):
    n = max(s[0], 1)
    return np.array([math.log(max(s[1], 1) / n), math.log1p(s[2] / n), math.sqrt(s[3] / n),
                     math.asin(math.sqrt(min(1, s[4] / n)))])


def verdicts(rows):
    """The estimator in numpy: (kept) of every (text, lang, source)."""
    stats = [statistics(r[0]) for r in rows]
    failed = [s[0] < 50 or 100 * s[4] > 50 * s[0] for s in stats]
    counts = Counter((r[1], r[2]) for r, f in zip(rows, failed, strict=True) if not f)
    pools = Counter()
    for (lang, _), n in counts.items():
        pools[lang] += n if n < outliers.MIN_ROWS else 0
    group = []
    for r in rows:
        n = counts.get((r[1], r[2]), 0)
        group.append(("all",) if not n else (r[1], r[2]) if n >= outliers.MIN_ROWS else
                     (r[1],) if pools[r[1]] >= outliers.MIN_ROWS else ("all",))
    floors = np.diag(np.array(list(outliers.FLOORS.values())) ** 2)
    members = defaultdict(list)
    for i, g in enumerate(group):
        if not failed[i]:
            members[g].append(i)
    model = {}
    for g, index in members.items():
        x = np.array([transformed(stats[i]) for i in index])

        def edge(bins, share):
            ordered = np.sort(bins)
            return ordered[math.ceil(share * len(ordered) - 1e-9) - 1]

        centre = np.array([edge(np.round(x[:, k] * 500), 0.5) / 500 for k in range(4)])
        cov = 4 * floors
        for _ in range(outliers.STEPS):
            far = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)
            bins = np.round(np.log1p(far) * 200)
            near = x[bins <= edge(bins, outliers.SUBSET)]
            centre = near.mean(axis=0)
            cov = outliers.consistency(outliers.SUBSET) * np.cov(near.T, bias=True) + floors
        model[g] = centre, np.linalg.inv(cov)
    out = []
    for s, f, g in zip(stats, failed, group, strict=True):
        if f or g not in model:
            out.append(not f)
            continue
        d = transformed(s) - model[g][0]
        out.append(bool(d @ model[g][1] @ d <= outliers.cutoff()))
    return stats, failed, out


@pytest.mark.parametrize("which", ["awkward", "table"])
def test_quality_equals_brute_force(spark, which):
    if which == "awkward":
        docs = documents(spark, AWKWARD, clashing=True)
    else:
        docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = docs.select("doc_id", "text", "lang", "source").collect()
    stats, failed, kept = verdicts([(r.text, r.lang, r.source) for r in rows])
    want = [(r.doc_id, *s, f, k) for r, s, f, k in zip(rows, stats, failed, kept, strict=True)]
    got = outliers.quality(docs).select("doc_id", *outliers.STATISTICS, "base_failed", "kept")
    assert plain(got.collect()) == plain(want)
    good = outliers.keep_good(docs)
    assert good.columns == docs.columns and good.count() == sum(kept)
    assert outliers.quality(docs.limit(0)).collect() == []
    assert outliers.keep_good(docs.limit(0)).collect() == []


def test_clean_stays_and_junk_goes(spark):
    rng = random.Random(4)

    def prose(n):
        return " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9)))
                        for _ in range(n))

    good = [(i, prose(rng.randint(60, 900)), "en", "s") for i in range(300)]
    junk = [(1000 + i, " ".join(w + "###" for w in prose(200).split()), "en", "s") for i in range(30)]
    junk += [(2000 + i, prose(30) + "\n" + "same line again here\n" * 40, "en", "s") for i in range(20)]
    rows = outliers.quality(documents(spark, good + junk)).collect()
    assert {r.doc_id for r in rows if r.kept} == {g[0] for g in good}


def test_repetition_the_base_rule_lets_pass_is_an_outlier(spark):
    rng = random.Random(9)

    def prose(n):
        return " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9)))
                        for _ in range(n))

    good = [(i, prose(rng.randint(60, 900)), "en", "s") for i in range(300)]
    good += [(500, f"{prose(23)}\n{(line := prose(9))}\n{prose(23)}\n{line}", "en", "s")]
    junk = [(1000, prose(520) + "\n" + f"{prose(5)}\n" * 96, "en", "s"),
            (1001, prose(520) + "\n" + f"{prose(10)}\n" * 48, "en", "s"),
            (1002, prose(520) + f" {prose(240)}" * 2, "en", "s")]
    rows = outliers.quality(documents(spark, good + junk)).collect()
    assert not any(r.base_failed for r in rows)
    assert {r.doc_id for r in rows if r.kept} == {g[0] for g in good}


def stated_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        open_ones = sum(weight[s] for s in names if s not in capped)
        level = rest / open_ones if open_ones else 0
        more = {s for s in names if s not in capped and level * weight[s] > 3 * sizes[s]}
        if not more:
            return {s: 3 * sizes[s] if s in capped else level * weight[s] for s in names}
        capped |= more



def test_targets_and_taken(spark):
    rng = random.Random(6)
    rows = [*AWKWARD]
    for n, (source, size) in enumerate([("small", 3), ("Zeta", 900), ("hot", 5000), (None, 700),
                                        ("éa", 1200), ("empty", 0)] * 9):
        rows.append((100 + n, "w " * rng.randint(0, 2 * size // 9 + 1) if size else None, "en", source))
    docs = documents(spark, rows, clashing=True)
    got = mixing.mix(docs).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words_of(r[1]))
    targets = stated_targets(sizes)
    assert plain((r.doc_id, r.size, r.source_size) for r in got) == plain(
        (r[0], len(words_of(r[1])), sizes[r[3]]) for r in rows)
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 2 * mixing.BLOCK
    assert plain(mixing.mix(docs.repartition(5)).collect()) == plain(got)
    assert mixing.mix(docs.limit(0)).collect() == []


def test_blocks_and_documents_hold_what_is_taken(spark):
    docs = table(spark, TESTDATA, "documents")
    total = sum(r.taken for r in mixing.mix(docs).collect())
    blocks = mixing.mixed_blocks(docs).collect()
    assert sum(len(b.words) for b in blocks) == total
    assert len({(b.shard, b.position) for b in blocks}) == len(blocks)
    texts = {r.doc_id: r.text for r in docs.collect()}
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    per = Counter()
    for r in mixed.collect():
        per[r.doc_id] += len(words_of(r.text))
        assert r.n_chars == len(r.text)
        if len(words_of(r.text)) == len(words_of(texts[r.doc_id])):
            assert r.text == texts[r.doc_id]
    assert {d: n for d, n in taken.items() if n} == dict(per)
    awkward = documents(spark, AWKWARD, clashing=True)
    assert mixing.mixed_documents(awkward).columns == awkward.columns
    assert mixing.mixed_documents(awkward).count() > 0
    assert mixing.mixed_documents(awkward.limit(0)).collect() == []


def test_repeated_rows_are_mixed_each(spark):
    rows = [(n, f"doc{n} " + "word " * 199, "en", s) for n in range(5) for s in ("a", "a", None)]
    docs = documents(spark, rows)
    mixed = mixing.mixed_documents(docs)
    got, want = Counter(), Counter()
    for r in mixed.collect():
        got[r.doc_id, r.source] += len(words_of(r.text))
    for r in mixing.mix(docs).collect():
        want[r.doc_id, r.source] += r.taken
    assert +got == +want and sum(got.values()) == sum(want.values()) >= 2000


def test_permutations_and_draws():
    for size in (1, 2, 3, 17, 100, 4097):
        assert sorted(mixing.permuted(np.arange(size), size, 7).tolist()) == list(range(size))
    quota = np.array([9000, 0, 13, 4000])
    shards = -(-int(quota.sum()) // mixing.SHARD_SLOTS)
    whole = list(mixing.drawn(quota, shards, 0, shards))
    assert sum(c for _, _, c in whole).tolist() == quota.tolist()
    assert [int(c.sum()) for _, _, c in whole][:-1] == [mixing.SHARD_SLOTS] * (shards - 1)
    for low in range(shards):
        (one,) = mixing.drawn(quota, shards, low, low + 1)
        assert one[0] == low and (one[1] == whole[low][1]).all() and (one[2] == whole[low][2]).all()


def test_language_of_held_out_rows(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = langid.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and len(held) > 100
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_awkward_rows(spark):
    docs = documents(spark, AWKWARD, clashing=True)
    rows = langid.identified(docs).collect()
    assert len(rows) == len(AWKWARD)
    unknown = Counter(r.doc_id for r in rows if r.lang_pred == "und")
    assert unknown == Counter([2, 3, 4, None])
    assert all(r.score == 0 and r.rejected for r in rows if r.lang_pred == "und")
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert langid.identified(docs.limit(0)).collect() == []
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identified(unlabelled).collect()} == {"und"}
