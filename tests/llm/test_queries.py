"""Registered queries against their SQL, and the pipeline against a brute-force version."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from logloom.llm import mixing, outliers, tokens
from logloom.llm.common import table
from logloom.llm.queries import ORACLES, QUERIES
from tests.conftest import TESTDATA
from tests.llm.helpers import AWKWARD, documents, plain
from tests.llm.test_duplicates_and_leaks import accepted

TABLES = "documents pages benchmark conversations labels".split()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, TESTDATA)
    rows = df.collect()
    if name not in ORACLES:
        if name.startswith("op13_"):
            of = table(spark, TESTDATA, "conversations").select("conv_id").distinct()
        else:
            of = table(spark, TESTDATA, "pages" if name.startswith("op12_") else "documents")
        if not name.startswith("op2_"):
            assert len(rows) == of.count()
        return
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{TESTDATA}/{t}.parquet'")
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    order = [columns.index(c) for c in df.columns]
    assert plain(rows) == plain(tuple(r[i] for i in order) for r in result.fetchall())


def test_leaks_of_the_table(spark):
    docs = {r.doc_id: r.text for r in table(spark, TESTDATA, "documents").collect()}
    items = {r.item_id: r.text for r in table(spark, TESTDATA, "benchmark").collect()}
    want = {(d, i) for d, t in docs.items() for i, b in items.items() if b.lower() in t.lower()}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op2_benchmark_leaks"](spark, TESTDATA).collect()}
    assert want and want <= got

    def split(text):
        return [w for w in re.split(r"[\W_]+", text.lower()) if w]

    assert all(accepted(split(items[i]), split(docs[d])) for d, i in got)


def test_pipeline_equals_brute_force(spark):
    docs = table(spark, TESTDATA, "documents")
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, TESTDATA))
        frames[name] = docs
    start = table(spark, TESTDATA, "documents").collect()
    good, near, clean, mixed, ids = (f.collect() for f in frames.values())
    # quality: its verdicts are tested against numpy, here that they take effect
    kept = {r.doc_id for r in outliers.quality(table(spark, TESTDATA, "documents")).filter("kept").collect()}
    assert plain(good) == plain(r for r in start if r.doc_id in kept)

    # near copies: all pairs by the sets of their five-word shingles
    rows = sorted(good, key=lambda r: r.doc_id)
    sets = [_shingles(r.text) for r in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = _up(root, i), _up(root, j)
                root[max(a, b)] = min(a, b)
    assert plain(near) == plain(r for n, r in enumerate(rows) if root[n] == n)
    items = [r.text.lower() for r in table(spark, TESTDATA, "benchmark").collect()]
    assert plain(clean) == plain(r for r in near if not any(b in r.text.lower() for b in items))
    taken = {r.doc_id: r.taken for r in mixing.mix(frames["benchmark decontamination"]).collect()}
    words = Counter()
    for r in mixed:
        words[r.doc_id] += len(r.text.split())
    assert dict(words) == {d: n for d, n in taken.items() if n}
    library = Tokenizer.from_file(tokens.vocabulary_path())
    want = []
    for r in mixed:
        got = [*library.encode(r.text, add_special_tokens=False).ids, 1]
        want.append((r.doc_id, len(got), zlib.crc32(np.array(got, "<u4").tobytes())))
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in ids) == sorted(want)
    begins = sorted((r.start, r.n_tokens) for r in ids)
    assert [b for b, _ in begins] == np.cumsum([0, *(n for _, n in begins)])[:-1].tolist()
    assert plain(corpus_pipeline.run(spark, TESTDATA).select("doc_id", "n_tokens").collect()) == plain(
        (r.doc_id, r.n_tokens) for r in ids)


def _up(root, n):
    while root[n] != n:
        n = root[n]
    return n


def _shingles(text):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text).encode().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_stages_take_awkward_and_empty_tables(spark):
    for rows in (AWKWARD, []):
        docs = documents(spark, rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.stored(stage(spark, docs, TESTDATA))
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert corpus_pipeline.STAGES[-1][1](spark, docs, TESTDATA).count() >= 0
