"""Language identification by averaged hashed subword embeddings and a linear softmax.

Subwords are the runs of one to three characters of the lower-cased text in which every run of
non-letters is one blank; each is hashed to a bucket with an embedding. A text is the mean of its
subwords' embeddings and a linear softmax scores the languages. Embeddings and weights are trained
together in numpy by stochastic gradient descent on a bounded sample of labelled rows
(`TRAIN_ROWS`); their product, one score per bucket and language, is what predicting needs.

A part of the sample is kept apart: it sets the temperature that makes the scores probabilities,
and the rejection threshold below which an answer is not to be trusted (`rejected`).

Defined cases: a text that is NULL or has no letter is `und` with score 0. If nothing can be
learned from, every answer is `und`. A row without an id counts as held out. Equal scores go to
the language that comes first. Repeated rows are answered alike; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import ship

#: Bound of the labelled rows that training takes, shared evenly by the languages.
TRAIN_ROWS = 2_000
BUCKETS = 1 << 14
DIMENSIONS = 16
EPOCHS = 12
SUBWORDS_PER_STEP = 200
RATE = 0.5
CALIBRATION_SHARE = 0.2
#: Subwords of the short pieces that set temperature and threshold: whole texts are too easy.
SHORT = 24
#: Share of wrong answers among calibration rows that the threshold may let through.
WRONG_SHARE = 0.001
UNKNOWN = "und"
CHUNK = 1_000_000


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5)) == 0


@cache
def letter_table() -> np.ndarray:
    """True for every code point that is a letter."""
    import unicodedata

    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


def buckets_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords of the texts, and the number of each text's subwords.

    Texts are laid one after another behind two blanks, so no subword crosses from one to the next.
    """
    joined = "  ".join([t.lower() for t in texts])
    lengths = np.array([len(t.lower()) for t in texts], dtype=np.int64)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts)), np.append(lengths[:-1] + 2, lengths[-1:]))
    letter = letter_table()[points]
    # one blank for every run of non-letters
    keep = letter | np.concatenate([[True], letter[:-1]])
    points = np.where(letter, points, 32)[keep].astype(np.uint32)
    owner, letter = owner[keep], letter[keep]
    prime = np.uint32(0x9E3779B1)
    out, whose = [], []
    one = points * prime
    for size in (1, 2, 3):
        code = one[: len(one) - size + 1] ^ np.uint32(size * 0x85EBCA6B & 0xFFFFFFFF)
        for k in range(1, size):
            code = (code * np.uint32(31) + one[k : len(one) - size + 1 + k]) * prime
        inside = letter[: len(one) - size + 1].copy()
        if size == 2:
            inside |= letter[1:]
        if size == 3:  # a blank may stand at either end, not in the middle
            inside = letter[1 : len(one) - 1].copy()
        mine = owner[size // 2 : size // 2 + len(code)]
        out.append((code >> np.uint32(18))[inside].astype(np.int32))
        whose.append(mine[inside])
    bucket = np.concatenate(out)
    whose = np.concatenate(whose)
    order = np.argsort(whose, kind="stable")
    return bucket[order], np.bincount(whose, minlength=len(texts))


def sample(docs: DataFrame) -> DataFrame:
    """At most `TRAIN_ROWS` labelled rows that are not held out: `lang, bucket, times`.

    Only a hash of the id chooses rows; a text arrives as its at most `BUCKETS` bucket counts.
    """
    ship(docs.sparkSession)
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()
                         & ~held_out(F.col("doc_id")))
    counts = {r.lang: r.n for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), "lang").limit(TRAIN_ROWS).collect()}
    each = TRAIN_ROWS // max(1, len(counts))
    order = F.xxhash64("doc_id", F.lit(4))
    place = (F.pmod(order, F.lit(1 << 30)) / (1 << 30)).alias("place")
    share = F.lit(0.0)
    for lang, n in sorted(counts.items()):
        share = F.when(F.col("lang") == lang, min(1.0, 2 * each / n)).otherwise(share)
    some = usable.select("doc_id", "lang", "text", place).filter(F.col("place") < share)
    first = Window.partitionBy("lang").orderBy("place", "doc_id", F.xxhash64("text"))
    some = some.withColumn("nr", F.row_number().over(first)).filter(F.col("nr") <= each)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, times = [], []
            for text in batch["text"].to_pylist():
                found, n = np.unique(buckets_of([text])[0], return_counts=True)
                ids.append(found.tolist())
                times.append(n.tolist())
            yield pa.record_batch({
                "lang": batch["lang"], "bucket": pa.array(ids, pa.list_(pa.int32())),
                "times": pa.array(times, pa.list_(pa.int32()))})

    return some.select("lang", "text", "place").mapInArrow(
        count, "lang string, bucket array<int>, times array<int>")


class Model:
    """Languages, the score of every bucket for each, temperature and threshold."""

    def __init__(self, langs: list[str], scores: np.ndarray, heat: float, threshold: float):
        self.langs, self.scores = langs, scores.astype(np.float32)
        self.heat, self.threshold = heat, threshold

    def probabilities(self, bucket: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Per text; texts without subwords get equal shares."""
        sums = np.zeros((len(count), len(self.langs)))
        full = np.flatnonzero(count)
        if len(full):
            begins = (np.cumsum(count) - count)[full]
            for n in range(len(self.langs)):
                sums[full, n] = np.add.reduceat(
                    self.scores[:, n][bucket], begins, dtype=np.float64)
        mean = sums / np.maximum(count, 1)[:, None] / self.heat
        mean -= mean.max(axis=1, keepdims=True)
        shares = np.exp(mean)
        return shares / shares.sum(axis=1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]]) -> Model | None:
    """Fit on (language, buckets, times); None if no row has a subword."""
    rows = sorted(((lang, b, t) for lang, b, t in rows if len(b)),
                  key=lambda r: (r[0], len(r[1]), r[1].tolist()[:8]))
    if not rows:
        return None
    langs = sorted({r[0] for r in rows})
    rng = np.random.default_rng(4)
    order = rng.permutation(len(rows))
    apart = set(order[: int(len(rows) * CALIBRATION_SHARE)].tolist())
    target = np.array([langs.index(r[0]) for r in rows])
    fit = [i for i in range(len(rows)) if i not in apart]
    embedding = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    weights = np.zeros((DIMENSIONS, len(langs)))
    steps, done = EPOCHS * len(fit), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(fit):
            _, bucket, times = rows[i]
            rate = RATE * (1 - done / steps)
            done += 1
            drawn = rng.choice(bucket, SUBWORDS_PER_STEP, p=times / times.sum())
            mean = embedding[drawn].mean(axis=0)
            score = mean @ weights
            share = np.exp(score - score.max())
            share /= share.sum()
            share[target[i]] -= 1
            back = weights @ share
            weights -= rate * np.outer(mean, share)
            np.subtract.at(embedding, drawn, rate * back / len(drawn) * 10)
    product = embedding @ weights
    model = Model(langs, product, 1.0, 0.0)
    held = sorted(apart) or fit
    means = np.array([product[rng.choice(rows[i][1], SHORT, p=rows[i][2] / rows[i][2].sum())].mean(
        axis=0) for i in held])
    truth = target[held]

    def loss(heat: float) -> float:
        x = means / heat
        x = x - x.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(x).sum(axis=1)) - x[np.arange(len(x)), truth]))

    model.heat = min(np.geomspace(0.02, 20, 121).tolist(), key=loss)
    x = means / model.heat
    share = np.exp(x - x.max(axis=1, keepdims=True))
    share /= share.sum(axis=1, keepdims=True)
    top, right = share.max(axis=1), share.argmax(axis=1) == truth
    best = np.argsort(-top, kind="stable")
    wrong = np.cumsum(~right[best])
    allowed = np.flatnonzero(wrong <= WRONG_SHARE * np.arange(1, len(best) + 1))
    model.threshold = float(top[best][allowed[-1]]) if len(allowed) else 1.0
    return model


def learned(docs: DataFrame) -> Model | None:
    return train([(r.lang, np.array(r.bucket), np.array(r.times)) for r in sample(docs).collect()])


def predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    """`doc_id, lang_pred, score, rejected`; only the text is looked at."""
    ship(docs.sparkSession)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            langs, scores, low = [], [], 0
            while low < len(texts):
                high, held = low, 0
                while high < len(texts) and (high == low or held + len(texts[high]) < CHUNK):
                    held += len(texts[high])
                    high += 1
                bucket, count = buckets_of(texts[low:high])
                shares = model.probabilities(bucket, count) if model else np.zeros((high - low, 1))
                best = shares.argmax(axis=1)
                for n in range(high - low):
                    known = model is not None and count[n] > 0
                    langs.append(model.langs[best[n]] if known else UNKNOWN)
                    scores.append(float(min(1.0, shares[n, best[n]])) if known else 0.0)
                low = high
            least = model.threshold if model else 1.0
            yield pa.record_batch({
                "doc_id": batch["doc_id"], "lang_pred": pa.array(langs, pa.string()),
                "score": pa.array(scores, pa.float64()),
                "rejected": pa.array([s < least for s in scores], pa.bool_())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(
        answer, "doc_id long, lang_pred string, score double, rejected boolean")


def identified(docs: DataFrame) -> DataFrame:
    """Train on the rows that are not held out and answer for all."""
    return predicted(docs, learned(docs)).withColumn("held_out", held_out(F.col("doc_id")))
