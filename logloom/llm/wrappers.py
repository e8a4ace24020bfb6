"""Main text of pages by wrapper induction.

A host's wrapper is induced from all its pages. One of them, the shortest with the host's most
usual set of tags, is the pattern; the block tree of every page is aligned with the pattern's by
simple tree matching. Slots of the pattern whose text most pages repeat are template, the other
slots vary and hold content. What the tags say decides first: the article a page marks, without
menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments.

Pages of a host never gather: the pattern is joined to them, and only counts by slot come back.

Defined cases: NULL html or no text gives the empty string. A NULL url, or one without a host,
has no wrapper, nor have hosts of fewer than `MIN_PAGES` pages. If most of a marked article is
repeated over its host, the pages are copies and keep it. If nothing but template is left of an
unmarked page, it stays. Page ids may repeat; every row is treated by itself. An empty table gives
no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm import dom
from logloom.llm.common import ship, stored
from logloom.operators.lookup import lookup_join

MIN_PAGES = 5
SHARE = 0.6
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
BLOCKS_DDL = "array<struct<text:string,slot:int,same:boolean>>"


def patterns(pages: DataFrame) -> DataFrame:
    """`host`, its number of `pages` and the html of its pattern; `pages` has host and html."""
    tags = F.array_sort(F.array_distinct(F.regexp_extract_all("html", F.lit(r"<([A-Za-z][A-Za-z0-9]*)"), 1)))
    known = pages.filter("host <> ''").select(
        "host", F.xxhash64("html").alias("mark"), F.length("html").alias("size"), F.xxhash64(tags).alias("layout"))
    kinds = known.groupBy("host", "layout").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("size", "mark")).alias("least"))
    usual = kinds.groupBy("host").agg(
        F.max_by("least", F.struct("n", "layout")).alias("least"), F.sum("n").alias("pages"))
    usual = usual.filter(F.col("pages") >= MIN_PAGES).select("host", "pages", F.col("least.mark").alias("mark"))
    marked = pages.withColumn("mark", F.xxhash64("html"))
    chosen = lookup_join(marked, usual, ["host", "mark"], "inner", spread="html")
    return chosen.groupBy("host").agg(F.min("html").alias("pattern"), F.first("pages").alias("pages"))


@lru_cache(64)
def pattern_tree(page: str) -> dom.Node:
    root = dom.tree(page)
    dom.numbered(root)
    return root


def page_blocks(page: str, pattern: str | None) -> tuple[list[dict], bool]:
    """Text blocks of the article with their slots in the pattern, and whether the page marks it."""
    root = dom.tree(page)
    texts, marked = dom.article(root)
    slots = {}
    if pattern is not None and texts:
        _, pairs = dom.match(pattern_tree(pattern), root)
        slots = {id(b): (a.slot, a.text == b.text) for a, b in pairs}
    out = []
    for leaf in texts:
        slot, same = slots.get(id(leaf), (-1, False))
        out.append({"text": leaf.text, "slot": slot, "same": same})
    return out, marked


def aligned(pages: DataFrame) -> DataFrame:
    """`page_id`, `url`, `host`, the article's `blocks` and whether it is `marked`; computed once."""
    ship(pages.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, marks = [], []
            for page, pattern in zip(*(batch.column(c).to_pylist() for c in ("html", "pattern"))):
                found, marked = page_blocks(page, pattern)
                blocks.append(found)
                marks.append(marked)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("page_id", "url", "host")), pa.array(blocks, kind),
                 pa.array(marks, pa.bool_())],
                names=["page_id", "url", "host", "blocks", "marked"])

    kind = pa.list_(pa.struct([("text", pa.string()), ("slot", pa.int32()), ("same", pa.bool_())]))
    host = F.lower(F.coalesce(F.regexp_extract("url", HOST, 1), F.lit("")))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), host.alias("host"),
                        F.coalesce("html", F.lit("")).alias("html"))
    met = lookup_join(rows, patterns(rows).select("host", "pattern"), ["host"], spread="html")
    read_in = met.select("page_id", "url", "host", "html", "pattern")
    return stored(read_in.mapInArrow(
        read, f"page_id long, url string, host string, blocks {BLOCKS_DDL}, marked boolean"), "blocks")


def templates(found: DataFrame) -> DataFrame:
    """`host` and the `constant` slots of its pattern: the same text on most of its pages."""
    pages = found.filter("host <> ''").groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    same = found.select("host", F.explode(F.array_distinct(F.transform(
        F.filter("blocks", lambda b: b["same"]), lambda b: b["slot"]))).alias("slot"))
    counts = same.groupBy("host", "slot").agg(F.count(F.lit(1)).alias("n"))
    both = counts.join(pages.withColumnRenamed("host", "_host"), F.col("host") == F.col("_host"))
    often = both.filter((F.col("n") >= F.col("pages") * SHARE) & (F.col("pages") >= MIN_PAGES))
    return often.groupBy("host").agg(F.array_sort(F.collect_list("slot")).alias("constant"))


def extracted(pages: DataFrame) -> DataFrame:
    """`page_id`, `url`, main `text`, its code points `n_chars` and the blocks left out as template."""
    found = aligned(pages)
    met = lookup_join(found, templates(found), ["host"], spread="page_id")

    def template(block):
        return block["same"] & F.array_contains("constant", block["slot"])

    def size(blocks):
        return F.aggregate(blocks, F.lit(0), lambda a, b: a + F.length(b["text"]))

    known = F.col("constant").isNotNull()
    fixed = F.filter("blocks", template)
    copied = F.when(F.col("marked"), 2 * size(fixed) >= size(F.col("blocks"))).otherwise(
        F.size(fixed) == F.size("blocks"))
    kept = F.when(known & ~copied, F.filter("blocks", lambda b: ~template(b))).otherwise(F.col("blocks"))
    rows = met.select("page_id", "url", F.size("blocks").alias("all"), kept.alias("kept"))
    text = F.concat_ws("\n\n", F.transform("kept", lambda b: b["text"]))
    rows = rows.select("page_id", "url", text.alias("text"), (F.col("all") - F.size("kept")).alias("n_template"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_template")
