"""Chat formatting with a grammar round trip.

A turn is `<|im_start|>role NEWLINE text<|im_end|> NEWLINE`; a conversation is its turns. The
parser is deterministic: it cuts at end marks, requires a start mark at the front of each part,
takes the role up to the first line end, and removes one backslash from each `<\\...|`. Every
turn is rendered as it is, parsed again and compared with its source; where they differ (control
strings, or text that looks escaped) one backslash is put into each `<|`, `<\\|`, ..., and the
result compared again. The whole conversation is parsed once more and must equal its source.
Columns, one window and one aggregate; all turns of a conversation meet, for they are one string.

Defined cases: NULL text and role are empty. Turns with equal numbers are ordered by role, then
text; a missing number comes first; repeated rows are all kept. A NULL conversation id is an id.
Percent signs, line ends and `<` in roles are percent-coded. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions.once import let

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
CODED = (("%", "%25"), ("\n", "%0A"), ("<", "%3C"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def role_out(role: Column) -> Column:
    for plain, coded in CODED:
        role = F.replace(role, F.lit(plain), F.lit(coded))
    return role


def role_in(role: Column) -> Column:
    for plain, coded in reversed(CODED):
        role = F.replace(role, F.lit(coded), F.lit(plain))
    return role


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role_out(role), F.lit("\n"), text, F.lit(END + "\n"))


def parsed(output: Column) -> Column:
    """Turns (role, text) of a rendered conversation; NULL in place of a part that is no turn."""
    parts = F.split(output, r"<\|im_end\|>\n")
    turns = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part: Column) -> Column:
        head = F.instr(part, "\n")
        body = F.substring(part, head + 1, F.length(part))
        role = F.substring(part, F.lit(len(START) + 1), head - len(START) - 1)
        good = part.startswith(START) & (head > 0) & ~body.contains(START) & ~body.contains(END)
        return F.when(good, F.struct(role_in(role).alias("role"), unescape(body).alias("text")))

    return F.transform(turns, turn)


def source_line(role: Column, text: Column) -> Column:
    return F.concat(role, F.lit("\n"), text, F.lit("\n"))


def safe_turns(turns: DataFrame) -> DataFrame:
    """`conv_id, turn, role, text, piece, inner`: each turn rendered so that it parses back."""
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    own = F.array(F.struct("role", "text"))
    plain = F.coalesce(parsed(rendered(F.col("role"), F.col("text"))) == own, F.lit(False))
    rows = rows.withColumn("inner", F.when(plain, F.col("text")).otherwise(escape(F.col("text"))))
    piece = rendered(F.col("role"), F.col("inner"))
    same = F.coalesce(parsed(piece) == own, F.lit(False))
    return rows.withColumn("piece", F.when(same, piece).otherwise(
        F.raise_error("a turn does not survive the round trip").cast("string")))


def formatted(turns: DataFrame) -> DataFrame:
    """One row per conversation: `formatted`, its loss spans, and the digest of its source.

    `loss_spans` holds (start, length) in code points of `formatted`, one for each assistant
    text as rendered.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = safe_turns(turns).withColumns({
        "nr": F.row_number().over(order),
        "at": F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0))})
    head = len(START) + F.length(role_out(F.col("role"))) + 1
    span = F.when(F.col("role") == ASSISTANT, F.struct(
        "nr", (F.col("at") + head).cast("long").alias("start"),
        F.length("inner").cast("long").alias("length")))

    def joined(name: str) -> Column:
        return F.array_join(F.transform(F.sort_array(F.col(name)), lambda x: x["s"]), "")

    return placed.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.collect_list(F.struct("nr", F.col("piece").alias("s"))).alias("pieces"),
        F.collect_list(F.struct("nr", source_line(F.col("role"), F.col("text")).alias("s"))
                       ).alias("lines"),
        F.collect_list(span).alias("spans"),
    ).select(
        "conv_id", "n_turns", joined("pieces").alias("formatted"),
        F.sha2(joined("lines"), 256).alias("source_sha256"),
        F.transform(F.sort_array("spans"), lambda x: F.struct(x["start"], x["length"])
                    ).alias("loss_spans"))


def read_back(conversations: DataFrame) -> DataFrame:
    """Digests of what the parser recovers from `formatted`; an error if it is not the source."""

    def joined(turns: Column) -> Column:
        return F.array_join(F.transform(turns, lambda t: source_line(t["role"], t["text"])), "")

    def loss(turns: Column) -> Column:
        said = F.filter(turns, lambda t: t["role"] == ASSISTANT)
        return F.array_join(F.transform(said, lambda t: t["text"]), "")

    def digests(turns: Column) -> Column:
        return let(loss(turns), lambda said: F.struct(
            F.size(turns).cast("long").alias("n_turns"),
            F.sha2(joined(turns), 256).alias("turns_sha256"),
            F.length(said).cast("long").alias("loss_chars"),
            F.sha2(said, 256).alias("loss_sha256")))

    found = conversations.select(
        "conv_id", "source_sha256", F.length("formatted").cast("long").alias("formatted_chars"),
        F.inline(F.array(let(parsed(F.col("formatted")), digests))))
    same = F.coalesce(F.col("turns_sha256") == F.col("source_sha256"), F.lit(False))
    return found.select(
        "conv_id", "n_turns",
        F.when(same, F.col("turns_sha256")).otherwise(
            F.raise_error("a conversation does not survive the round trip").cast("string")
        ).alias("turns_sha256"),
        "loss_chars", "loss_sha256", "formatted_chars")
