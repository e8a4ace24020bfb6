"""Quality rules: robust multivariate outliers among documents of one language and source.

Every text becomes a vector of four transformed statistics. For each (language, source) the
minimum-covariance-determinant estimate of centre and covariance is found by concentration
steps; a document whose Mahalanobis distance from the centre exceeds the chi-square cutoff is
rejected, as is one that fails the base rules. Columns and aggregates only.

Defined cases: a NULL or empty text has no words and fails the base rules. A NULL language or
source is a value of its own. A group of fewer than `MIN_ROWS` usable documents is pooled with
the other small groups of its language, and a small pool with all small pools. Repeated rows are
judged alike, one by one. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions.once import let, once
from logloom.llm.common import SPACE, minus, stored, words
from logloom.operators.lookup import lookup_join

SYMBOLS = "#*$%&|<>"
MIN_ROWS = 60
SUBSET = 0.75
STEPS = 4
TAIL = 1e-6
#: Standard deviation added to each coordinate: half of most groups has no symbol and no repeat.
#: Those of lines and repeats are the noise of the shortest texts: one line of nine words that
#: comes twice among 64 words stays below the cutoff, repeats alone pass it from 36 % on.
FLOORS = {"length": 0.06, "symbols": 0.04, "lines": 0.05, "repeats": 0.11}
VECTOR = tuple(FLOORS)
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(word: Column) -> Column:
    """Words inside 3-word windows that occur at least twice, by sorted window hashes."""
    n = F.size(word)
    hashes = F.when(n >= 3, F.transform(
        F.slice(word, 1, n - 2),
        lambda x, i: F.xxhash64(x, F.get(word, i + 1), F.get(word, i + 2)),
    )).otherwise(F.array().cast("array<bigint>"))

    def covered(ordered: Column) -> Column:
        again = F.filter(ordered, lambda e, i: (
            F.coalesce(F.get(ordered, i - 1)["h"] == e["h"], F.lit(False))
            | F.coalesce(F.get(ordered, i + 1)["h"] == e["h"], F.lit(False))))
        places = F.sort_array(F.transform(again, lambda e: e["i"]))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("at"))
        return F.aggregate(places, start, lambda s, p: F.struct(
            (s["n"] + F.least(F.lit(3), p - s["at"])).alias("n"), p.alias("at")))["n"]

    def of(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            let(pairs, covered))

    return let(hashes, of)


def statistics(docs: DataFrame) -> DataFrame:
    """`docs` with the five base statistics of `text`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = once(docs, _words=words(F.col("text")))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t\\n\\x0B\\f\\r]"))
    word = F.col("_words")
    return once(
        split,
        n_words=F.size(word).cast("long"),
        word_chars=F.length(F.translate(text, SPACE, "")).cast("long"),
        n_symbols=(F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        n_dup_lines=let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        n_repeat_words=repeated_words(word),
    ).drop("_words")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def vector() -> dict[str, Column]:
    """Transformed statistics: each is near 0 or symmetric for ordinary prose of any length."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        "symbols": F.log1p(F.col("n_symbols") / n),
        "lines": F.sqrt(F.col("n_dup_lines") / n),
        "repeats": F.asin(F.sqrt(F.least(F.lit(1.0), F.col("n_repeat_words") / n))),
    }


def cutoff(tail: float = TAIL) -> float:
    """The chi-square value with four degrees of freedom that `tail` of all rows exceed."""
    low, high = 0.0, 1e4
    while high - low > 1e-9:
        mid = (low + high) / 2
        low, high = (mid, high) if math.exp(-mid / 2) * (1 + mid / 2) > tail else (low, mid)
    return high


def consistency(share: float) -> float:
    """Factor that makes the covariance of the closest `share` of normal rows unbiased."""
    x = cutoff(1 - share) / 2
    return share / (1 - math.exp(-x) * (1 + x + x * x / 2))


def binned(value: Column, per_unit: int) -> Column:
    return F.round(value * per_unit).cast("long")


def group_quantile(rows: DataFrame, bin_name: str, share: float) -> DataFrame:
    """(group, edge): the smallest bin up to which `share` of a group's rows lie.

    Counts of bins are summed before the shuffle; a group of any size leaves at most a few
    thousand bins.
    """
    counts = rows.groupBy("group", bin_name).agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy("group").orderBy(bin_name)
    whole = Window.partitionBy("group")
    return (
        counts.withColumn("up_to", F.sum("n").over(running))
        .withColumn("all", F.sum("n").over(whole))
        .filter(F.col("up_to") >= F.lit(share) * F.col("all"))
        .groupBy("group").agg(F.min(bin_name).alias("edge"))
    )


def settle_groups(rows: DataFrame) -> DataFrame:
    """`rows` with `group`: language and source, pooled where the group is too small."""
    counts = rows.filter("not base_failed").groupBy("_lang", "_source").agg(
        F.count(F.lit(1)).alias("n"))
    small = F.col("n") < MIN_ROWS
    by_lang = Window.partitionBy("_lang", small)
    chosen = counts.withColumn("pool", F.sum("n").over(by_lang)).select(
        "_lang", "_source",
        F.when(~small, F.to_json(F.array("_lang", "_source")))
        .when(F.col("pool") >= MIN_ROWS, F.to_json(F.array("_lang")))
        .otherwise("[]").alias("group"))
    joined = lookup_join(rows, chosen, ["_lang", "_source"], spread="doc_id")
    return joined.withColumn("group", F.coalesce("group", F.lit("[]")))


def squared_distance() -> Column:
    """Mahalanobis distance by forward substitution with the group's Cholesky factor."""
    solved: list[Column] = []
    for i, name in enumerate(VECTOR):
        rest = F.col(name) - F.col(f"m_{name}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * solved[j]
        solved.append(rest / F.col(f"l{i}{i}"))
    return reduce(lambda a, b: a + b, (x * x for x in solved))


def factored(moments: DataFrame, scale: float) -> DataFrame:
    """Centre and Cholesky factor of the floored covariance, from sums of products."""
    out = moments
    for name in VECTOR:
        out = out.withColumn(f"m_{name}", F.col(f"s_{name}") / F.col("n"))
    for i, a in enumerate(VECTOR):
        for j in range(i + 1):
            b = VECTOR[j]
            value = scale * (F.col(f"s_{b}_{a}") / F.col("n") - F.col(f"m_{a}") * F.col(f"m_{b}"))
            if i == j:
                value = F.greatest(value, F.lit(0.0)) + FLOORS[a] ** 2
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            value = F.sqrt(F.greatest(value, F.lit(1e-9))) if i == j else value / F.col(f"l{j}{j}")
            out = out.withColumn(f"l{i}{j}", value)
    names = [f"m_{n}" for n in VECTOR] + [f"l{i}{j}" for i in range(4) for j in range(i + 1)]
    return out.select("group", *names)


def moments(rows: DataFrame) -> DataFrame:
    """Sums and sums of products of each group, over values held as whole numbers.

    Whole sums do not depend on the order in which partial sums meet, so reruns agree.
    """
    unit = 1_000_000

    def whole(x: Column) -> Column:
        return F.sum(F.round(x * unit).cast("decimal(38,0)")).cast("double") / unit

    pairs = [(VECTOR[j], VECTOR[i]) for i in range(4) for j in range(i + 1)]
    return rows.groupBy("group").agg(
        F.count(F.lit(1)).alias("n"),
        *(whole(F.col(v)).alias(f"s_{v}") for v in VECTOR),
        *(whole(F.col(a) * F.col(b)).alias(f"s_{a}_{b}") for a, b in pairs),
    )


def starting_point(rows: DataFrame) -> DataFrame:
    """Coordinate-wise medians, and deviations around them, as a first centre and factor."""
    out = None
    for name in VECTOR:
        middle = group_quantile(rows.withColumn("bin", binned(F.col(name), 500)), "bin", 0.5)
        middle = middle.select("group", (F.col("edge") / 500.0).alias(f"m_{name}"))
        out = middle if out is None else out.join(middle, "group")
    return out.select(
        "group", *(f"m_{n}" for n in VECTOR),
        *(F.lit(2 * FLOORS[VECTOR[i]] if i == j else 0.0).alias(f"l{i}{j}")
          for i in range(4) for j in range(i + 1)))


def estimates(rows: DataFrame) -> DataFrame:
    """Centre and Cholesky factor by group: concentration steps from robust medians.

    Each step keeps the `SUBSET` of a group's rows closest to the last estimate and takes their
    mean and covariance, which never raises the determinant.
    """
    used = rows.filter("not base_failed").select("group", "doc_id", *VECTOR)
    now = starting_point(used)
    for _ in range(STEPS):
        far = lookup_join(used, now, ["group"], spread="doc_id").withColumn(
            "bin", binned(F.log1p(squared_distance()), 200))
        edges = group_quantile(far, "bin", SUBSET)
        near = lookup_join(far, edges, ["group"], how="inner", spread="doc_id").filter("bin <= edge")
        now = factored(moments(near), consistency(SUBSET))
    return now


def judged(stats: DataFrame, tail: float = TAIL) -> DataFrame:
    """Rows with the five statistics, `base_failed`, `distance` (squared) and `kept`.

    `stats` is read several times: give a stored table.
    """
    rows = stats.withColumns({
        "base_failed": base_failed(), **vector(),
        "_lang": F.to_json(F.array("lang")), "_source": F.to_json(F.array("source"))})
    rows = settle_groups(rows)
    out = lookup_join(rows, estimates(rows), ["group"], spread="doc_id")
    out = out.withColumn("distance", F.when(~F.col("base_failed"), squared_distance()))
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(
        F.col("distance") <= cutoff(tail), F.lit(True)))


def quality(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """Verdict on every document: ids, statistics, `base_failed`, `distance`, `kept`."""
    thin = stored(statistics(docs.select("doc_id", "lang", "source", "text")).select(
        "doc_id", "lang", "source", F.xxhash64("text").alias("_text"), *STATISTICS), "statistics")
    return judged(thin, tail)


def keep_good(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """The documents that pass, with their own columns."""
    bad = quality(docs, tail).filter("not kept").withColumnRenamed("doc_id", "_id")
    return minus(docs, bad)
