import io
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logloom.llm import repair, tokens
from logloom.llm.common import scratch
from tests.conftest import TESTDATA
from tests.llm.helpers import AWKWARD, documents


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.vocabulary_path())


def count(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_every_prefix_has_the_library_count(library):
    own = tokens.PrefixCounter(tokens.vocabulary_path())
    rng = random.Random(3)
    texts = [
        "it's they're WE'LL x're' ''s don't.,", "a<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>",
        "Éa Ñandú ÜBER straße İ Σας é 你好 123x !!?",
        "a b a\x1cb  \n\n c ", "", " ", "internationalization counterrevolutionaries",
    ]
    texts += ["".join(rng.choice("aeithnors'.,!<|é ñ1 \n") for _ in range(30))
              for _ in range(60)]
    for text in texts:
        steps = np.frombuffer(own.steps(text), np.int8).astype(int)
        assert np.cumsum(steps).tolist() == [
            count(library, text[:n]) for n in range(1, len(text) + 1)], text


def test_prefixes_of_runs_that_compose_have_the_library_count(library):
    own = tokens.PrefixCounter(tokens.vocabulary_path())
    rng = random.Random(5)
    letters = ("aertsdlmv''1=\u2212\u4f60\u304b.,!\u3000\xa0\xe9\xb3"
               "\u0338\u3099\u0327\u0323\u0301\u0130\u212b\u0958\u1100\u1161\u11a8\uac00")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 18))) for _ in range(800)]
    texts += ["".join(rng.choice("\u4ed6\u662f\u304e\u304b\u3099abe\u0301") for _ in range(300))
              for _ in range(5)]
    for text in texts:
        steps = np.frombuffer(own.steps(text), np.int8).astype(int)
        want = library.encode_batch_fast(
            [text[:n] for n in range(1, len(text) + 1)], add_special_tokens=False)
        assert np.cumsum(steps).tolist() == [len(e.ids) for e in want], ascii(text)


@pytest.mark.parametrize("base", ["\u4f60\u597d\u5b66", "\u304b\u3099\u304d", "nai\u0308ve"])
def test_a_long_run_that_composes_is_counted_in_linear_time(library, base):
    own = tokens.PrefixCounter(tokens.vocabulary_path())
    text = base * 33_333 + "e\u0301"
    begun = time.process_time()
    steps = np.frombuffer(own.steps(text), np.int8)
    assert time.process_time() - begun < 60
    assert int(steps.sum(dtype=np.int64)) == count(library, text)


def test_counts_of_the_documents_table(spark, library):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = tokens.prefix_counts(docs).select("doc_id", "n_tokens").collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {d: count(library, t) for d, t in texts.items()}


def test_counts_of_awkward_documents(spark, library):
    docs = documents(spark, AWKWARD, clashing=True)
    rows = tokens.prefix_counts(docs).collect()
    want = sorted((r[0] or -1, len((r[1] or "").encode()), count(library, r[1] or ""))
                  for r in AWKWARD)
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in rows) == want
    assert tokens.prefix_counts(docs.limit(0)).collect() == []


def test_truncation_without_encoding_again(spark, library):
    text = "The quick brown foxes aren't internationally known. " * 3
    steps = tokens.prefix_counts(documents(spark, [(1, text, "en", "a")]))
    row = steps.select(
        tokens.longest_within(F.col("prefix_steps"), F.lit(10)).alias("chars"),
        tokens.tokens_before(F.col("prefix_steps"), F.lit(17)).alias("n")).first()
    assert row.n == count(library, text[:17])
    fits = [n for n in range(len(text) + 1) if count(library, text[:n]) <= 10]
    assert row.chars == max(fits)


def test_shards_round_trip(spark, library):
    docs = documents(spark, AWKWARD, clashing=True)
    rows = repair.round_trip(docs).orderBy("start").collect()
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))

    def stated(row):
        got = [*library.encode(row[1] or "", add_special_tokens=False).ids, 1]
        return row[0], len(got), zlib.crc32(np.array(got, "<u4").tobytes())

    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows), key=repr) == sorted(
        map(stated, AWKWARD), key=repr)
    assert repair.round_trip(docs.limit(0)).collect() == []


def test_random_access_and_rules():
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 6, n).astype(np.uint32) for n in (5000, 1, 3000, 40)]
    packed = repair.shard_bytes([3, None, 5, 6], parts)
    assert len(packed) < sum(map(len, parts))
    shard = repair.Shard(io.BytesIO(packed))
    assert len(shard.grammar.sizes) > 10
    assert [shard.doc_id(n) for n in range(4)] == [3, None, 5, 6]
    for n in (2, 0, 3, 1):
        assert shard.document(n).tolist() == parts[n].tolist()
    assert [d.tolist() for d in shard.documents()] == [p.tolist() for p in parts]


def test_overlapping_pairs_go_to_the_more_frequent():
    # places 0 1 2 | 5 6 7 8 | 10, rules 0 (rare), 1 (frequent)
    place = np.array([0, 1, 2, 5, 6, 7, 8, 10])
    rule = np.array([0, 1, 0, 1, 1, 1, 0, 0])
    taken = repair.apart(place, rule, np.array([12, 40]))
    assert place[taken].tolist() == [1, 5, 7, 10]
    rng = np.random.default_rng(2)
    for _ in range(200):
        place = np.flatnonzero(rng.random(60) < 0.7)
        rule, count = rng.integers(0, 5, len(place)), rng.integers(12, 30, 5)
        got = place[repair.apart(place, rule, count)]
        assert (np.diff(got) > 1).all()  # none beside another
        assert all(p in got or p - 1 in got or p + 1 in got for p in place)


def test_every_rule_is_used_and_expands_to_its_length():
    rng = np.random.default_rng(4)
    words = [rng.integers(0, 900, rng.integers(1, 6)).astype(np.uint32) for _ in range(300)]
    parts = [np.concatenate([words[i] for i in np.minimum(rng.zipf(1.3, 80) - 1, 299)])
             for _ in range(200)]
    ids = np.concatenate(parts)
    symbols, last, left, right, _ = repair.compressed(ids, np.cumsum([len(p) for p in parts]), 900)
    used = set(symbols.tolist()) | set(left.tolist()) | set(right.tolist())
    assert len(left) > 20 and used >= set(range(900, 900 + len(left)))
    assert last.sum() == len(parts)
    shard = repair.Shard(io.BytesIO(repair.shard_bytes(list(range(len(parts))), parts)))
    assert [d.tolist() for d in shard.documents()] == [p.tolist() for p in parts]


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17, 24, 31])
def test_packed_bits_are_read_from_any_place(bits):
    values = np.random.default_rng(bits).integers(0, 1 << bits, 100).astype(np.uint32)
    raw = repair.packed(values, bits)
    assert len(raw) == repair.packed_size(100, bits)
    for low, high in ((0, 100), (0, 0), (3, 4), (50, 99)):
        begin = low * bits
        some = raw[begin // 8 : repair.packed_size(high, bits)]
        assert repair.unpacked(some, high - low, bits, begin % 8).tolist() == \
            values[low:high].tolist()


def test_shards_of_the_documents_table_are_right_and_smaller_than_plain_ids(spark, library):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    folder = scratch(spark, "tokens")
    index = repair.write(docs, folder)
    sums = index.selectExpr("sum(n_bytes) b", "sum(n_tokens) n").first()
    assert sums.b < 2 * sums.n
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in repair.read(index, folder).collect()}
    for row in docs.collect():
        ids = [*library.encode(row.text or "", add_special_tokens=False).ids, 1]
        assert got[row.doc_id] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_runs_cut_at_punctuation_have_the_ids_of_the_library(library, monkeypatch):
    monkeypatch.setattr(repair, "KEEP", 300)
    monkeypatch.setattr(repair, "FULL", 400)
    parts = ["a", "Be", "s", "t", "ll", "'", "'s", "'re", "\u2019", "&", "<", "=", ".", ",", "***", "|", "7", "\u00e9",
             "\u00c9", "\u00df", "\u00f7", "\u00d7", "\u00aa", "\u0301", "\u0338", "\u00a0", "\u1100", "\u1161", "\u0130",
             "\u2126", "\u65e5", "\x1c", " ", " ", "\n", "\t", "<|", "<|endoftext|>", "|>"]
    rng = random.Random(5)
    texts = ["".join(rng.choices(parts[:-3] if n % 4 else parts, k=rng.randrange(40))) for n in range(1500)]
    own = repair.Encoder(repair.vocabulary_path())
    for low in range(0, len(texts), 100):
        some = [None, *texts[low : low + 100], ""]
        ids, ends = own.encode(pa.array(some).slice(1))
        got = np.split(ids, ends[:-1])
        assert [g.tolist() for g in got] == [
            [*library.encode(t, add_special_tokens=False).ids, 1] for t in some[1:]]


def test_equal_runs_of_a_chunk_are_looked_up_once():
    class Known(dict):
        lookups = 0

        def get(self, run):
            self.lookups += 1
            return super().get(run)

    own = repair.Encoder(repair.vocabulary_path())
    own.known = Known(own.known)
    own.encode(pa.array(["Word, word. (word) word*** " * 50, "word!"]))
    assert set(own.known) == {b"", b"word", b",", b".", b"(", b")", b"***", b"!"}
    assert own.known.lookups == 2 * 7
