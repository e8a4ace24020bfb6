"""Token counts by dynamic programming over prefixes.

For every prefix of a text (in code points) the exact number of tokens that the tokenizer gives
for that prefix is stored, so truncation and budget questions need no encoding again. The merges
of byte-pair encoding have a prefix property: the encoding of a string is the encoding of a
shorter prefix plus one last token, and two tokens may stand side by side if encoding their
concatenation gives just these two. So the count of a prefix is that of the prefix before its
last token plus one, and each prefix is computed once for all words that share it. Counts of
words add up, for white space separates them.

`prefix_steps` holds the difference of neighbouring prefixes' counts, one signed byte for each
code point; the count of the prefix of n code points is the sum of the first n.

Defined cases: a NULL text is empty and has no step and no token. Special strings inside a text
are special tokens, as the library's default has it. Repeated rows are counted each; an empty
table gives no rows; other columns are ignored. A run without white space is handled in linear time
whatever its length and form; only the marks on one letter cost time in the square of their number.
"""

from __future__ import annotations

import functools
import gc
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import ship

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
BATCH_CHARS = 4_000_000
#: Entries of a worker's tables; those met first, the frequent ones, stay when a table is full.
KEEP, FULL = 300_000, 650_000
SHARED_PREFIX = 32
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
PARTS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
KINDS = regex.compile(r"(\p{L})|(\p{N})|(\p{White_Space})|.", regex.DOTALL)
LETTER, NUMBER, SPACE = 1, 2, 3


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def trim(table: dict, keep: int = KEEP, full: int = FULL) -> None:
    """Drop all but the first `keep` entries of a table with more than `full`."""
    if len(table) > full:
        late = list(table)[keep:]
        for key in late:
            del table[key]


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself, or the next free one from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, free = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in plain else free))
        free += byte not in plain
    return letters


def kind_of(char: str) -> int | None:
    """`LETTER`, `NUMBER`, `SPACE` or None for everything else."""
    return KINDS.match(char).lastindex


@functools.cache
def joining_starters() -> frozenset[str]:
    """Characters without a combining class that can compose with the character before."""
    out = {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}
    for code in range(0x110000):
        char = chr(code)
        sides = unicodedata.decomposition(char).split()
        if len(sides) == 2 and sides[0][0] != "<" and unicodedata.normalize("NFC", char) == char:
            second = chr(int(sides[1], 16))
            if not unicodedata.combining(second):
                out.add(second)
    return frozenset(out)


@functools.lru_cache(1 << 16)
def opens(char: str) -> bool:
    """Does normalising a text give the same as normalising its parts before and from `char`?"""
    first = unicodedata.normalize("NFD", char)[0]
    return not unicodedata.combining(first) and first not in joining_starters()


def composed(text: str) -> str:
    return "".join([c.lower() for c in unicodedata.normalize("NFC", text)])


class PrefixCounter:
    """Counts for all prefixes of words, from the vocabulary and merges of a tokenizer file."""

    END = "</w>"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        model = stated["model"]
        self.library = Tokenizer.from_file(path)
        self.specials = [t["content"] for t in stated["added_tokens"]]
        self.special_re = regex.compile("|".join(map(regex.escape, self.specials)))
        self.ends = self.suffixes(model["vocab"])
        self.longest = max(map(len, self.ends))
        self.ranks = {tuple(pair): n for n, pair in enumerate(model["merges"])}
        self.made_of: dict[str, tuple[int, str, str]] = {}
        for (left, right), n in self.ranks.items():
            self.made_of.setdefault(left + right, (n, left, right))
        self.letters = byte_letters()
        self.side_by_side: dict = {}
        self.steps_of: dict[bytes, bytes] = {}
        self.forget()

    def forget(self) -> None:
        """Drop the tree of prefixes: (last token, count, count as a word, next letters)."""
        self.root: tuple = ("", 0, 0, {})
        self.nodes = 0

    def suffixes(self, tokens) -> dict[str, int]:
        """Every suffix of the tokens, without the end mark: 1 if it is a token within a word,
        plus 2 if it is one at a word's end."""
        out: dict[str, int] = {}
        for token in tokens:
            body = token.removesuffix(self.END)
            for i in range(1, len(body)):
                out.setdefault(body[i:], 0)
            out[body] = out.get(body, 0) | (1 if len(body) == len(token) else 2)
        return out

    def fits(self, left: str, right: str) -> bool:
        """Does encoding left + right give these two tokens?

        The merges of both tokens are undone from the last one. If at some moment the pieces that
        meet would merge with each other before the merge undone there, the tokens cannot stand
        side by side. Of equal merges the one further left comes first.
        """
        key = (left, right)
        known = self.side_by_side.get(key)
        if known is None:
            trim(self.side_by_side)
            known = self.side_by_side[key] = not left or self.undone(left, right)
        return known

    def undone(self, left: str, right: str) -> bool:
        ranks, made_of, limit = self.ranks.get, self.made_of.get, 1 << 40
        first, second = made_of(left), made_of(right)
        while True:
            across = ranks((left, right))
            if across is not None and across < limit:
                return False
            if first is None and second is None:
                return True
            if second is None or (first is not None and first[0] > second[0]):
                limit, left = first[0], first[2]
                first = made_of(left)
            else:
                limit, right = second[0] + 1, second[1]
                second = made_of(right)

    def next_node(self, text: str, n: int, states: list) -> tuple:
        """The node of text[:n], from those of the shorter prefixes.

        Suffixes are lengthened as long as some token ends so; the longest that fits is the last
        token, once within a word and once at its end.
        """
        inner, word = [], []
        ends = self.ends.get
        for at in range(n - 1, -1, -1):
            kind = ends(text[at:n])
            if kind is None:
                break
            if kind & 1:
                inner.append(at)
            if kind & 2:
                word.append(at)
        closed = None
        fits = self.fits
        for at in reversed(word):
            before = states[at]
            if fits(before[0], text[at:n] + self.END):
                closed = before[1] + 1
                break
        for at in reversed(inner):
            before = states[at]
            token = text[at:n]
            if fits(before[0], token):
                return token, before[1] + 1, closed, {}
        raise ValueError("no token ends this prefix")

    def word_states(self, word: str) -> list[tuple]:
        """Nodes of word[:0], word[:1], ... for a word in the vocabulary's letters."""
        node = self.root
        states = [node]
        for n, letter in enumerate(word, 1):
            after = node[3].get(letter) if n <= SHARED_PREFIX else None
            if after is None:
                after = self.next_node(word, n, states)
                if n <= SHARED_PREFIX:
                    node[3][letter] = after
                    self.nodes += 1
            node = after
            states.append(node)
        return states

    def word_counts(self, word: str) -> list[int]:
        """Tokens of word[:1], word[:2], ..."""
        return [state[2] for state in self.word_states(word)[1:]]

    def count_with(self, word: str, states: list, size: int, more: str) -> int:
        """Tokens of word[:size] + more, from the states of the word."""
        low = max(0, size - self.longest)
        text, states = word[low:size] + more, states[low : size + 1]
        for n in range(size - low + 1, len(text) + 1):
            states.append(self.next_node(text, n, states))
        return states[-1][2]

    def part_counts(self, part: str) -> list[int]:
        """Counts for the prefixes, by code point, of one piece of the pre-tokenizer."""
        if part in CONTRACTIONS:
            rest = [1 + c for c in self.part_counts(part[1:-1])] if len(part) > 2 else []
            return [1, *rest, self.whole(part)]
        return self.plain_counts(part)

    def spelled(self, part: str) -> str:
        return "".join([self.letters[b] for b in part.encode()])

    def plain_counts(self, part: str) -> list[int]:
        raw = part.encode()
        counts = self.word_counts(self.spelled(part))
        if len(raw) == len(part):
            return counts
        ends = np.cumsum([len(c.encode()) for c in part])
        return [counts[e - 1] for e in ends]

    def whole(self, part: str) -> int:
        return self.plain_counts(part)[-1]

    def ordinary_counts(self, run: str) -> list[int]:
        """Counts for the prefixes of a run without special strings."""
        if run.isascii() and run.isalpha():
            return self.word_counts(run.lower())
        low = run if run.isascii() else "".join([c.lower() for c in run])
        if not run.isascii() and (len(low) != len(run) or not unicodedata.is_normalized("NFC", run)):
            return self.composing_counts(run)
        if run.isascii():
            low = low.lower()
        return self.normal_counts(low)

    def normal_counts(self, low: str) -> list[int]:
        """Counts for the prefixes of a run in lower case and composed form."""
        counts, done, at = [], 0, 0
        for found in PARTS.finditer(low):
            counts += [done] * (found.start() - at)
            own = self.part_counts(found.group())
            counts += [done + c for c in own]
            done, at = done + own[-1], found.end()
        return counts + [done] * (len(low) - at)

    def composing_counts(self, run: str) -> list[int]:
        """Counts for the prefixes of a run whose normal form has other code points.

        The run is cut where its parts can be normalised each for itself: a letter with its marks
        is one part. A prefix of whole parts is a prefix of the normal form. A prefix that ends
        inside a part is the normal form up to the part, and then what the open part gives.
        """
        begins = [0, *(n for n in range(1, len(run)) if opens(run[n])), len(run)]
        forms = [composed(run[a:b]) for a, b in zip(begins, begins[1:], strict=False)]
        low = "".join(forms)
        whole = [0, *self.normal_counts(low)]
        pieces = [found.span() for found in PARTS.finditer(low)]
        states: dict[int, tuple] = {}
        counts, size, piece = [], 0, 0
        for start, end, form in zip(begins, begins[1:], forms, strict=False):
            if end - start > 1:
                # the piece that holds the last letter before the part
                while piece < len(pieces) and pieces[piece][1] < size:
                    piece += 1
                span = pieces[piece] if piece < len(pieces) else (size, size)
                for n in range(start + 1, end):
                    counts.append(self.open_count(low, whole, size, span, states,
                                                  composed(run[start:n])))
            size += len(form)
            counts.append(whole[size])
        return counts

    def open_count(self, low: str, whole: list, size: int, span: tuple, states: dict,
                   tail: str) -> int:
        """Tokens of low[:size] + tail; `span` is the piece of `low` with its last letter."""
        if not size:
            return self.normal_counts(tail)[-1]
        before, first = kind_of(low[size - 1]), kind_of(tail[0])
        if before != first or first in (NUMBER, SPACE):
            if low[size - 1] != "'" or first != LETTER:
                return whole[size] + self.normal_counts(tail)[-1]
        elif span[0] < size <= span[1] and kind_of(low[span[0]]) == first and (
                first is None or low[span[0] - 1 : span[0]] != "'" or size - span[0] > 1):
            # the tail lengthens a piece that is no contraction and cannot become one
            if span[0] not in states:
                word = self.spelled(low[span[0] : span[1]])
                states.clear()
                states[span[0]] = word, self.word_states(word)
            word, nodes = states[span[0]]
            more = 1
            while more < len(tail) and kind_of(tail[more]) == first:
                more += 1
            own = self.count_with(word, nodes, len(low[span[0] : size].encode()),
                                  self.spelled(tail[:more]))
            rest = self.normal_counts(tail[more:])[-1] if more < len(tail) else 0
            return whole[span[0]] + own + rest
        # beside an apostrophe: from the last place where a piece must begin
        at = size
        while at and not self.breaks(low[at - 1], (low + tail)[at] if at == size else low[at]):
            at -= 1
        return whole[at] + self.normal_counts(low[at:size] + tail)[-1]

    @staticmethod
    def breaks(left: str, right: str) -> bool:
        """Does a piece begin between these two, whatever is around them?"""
        one, two = kind_of(left), kind_of(right)
        if one in (NUMBER, SPACE) or two in (NUMBER, SPACE):
            return True
        return one != two and not (left == "'" and two == LETTER)

    def run_counts(self, run: str) -> list[int]:
        """Counts for the prefixes of a run without ASCII white space."""
        counts: list[int] = []
        done, at = 0, 0
        for found in self.special_re.finditer(run) if "<|" in run else ():
            stretch = self.ordinary_counts(run[at : found.end() - 1])
            counts += [done + c for c in stretch]
            before = found.start() - at
            done += (stretch[before - 1] if before else 0) + 1
            counts.append(done)
            at = found.end()
        return counts + [done + c for c in self.ordinary_counts(run[at:])]

    def run_steps(self, run: bytes) -> bytes:
        steps = self.steps_of.get(run)
        if steps is None:
            end = run[-1:]
            if end in (b".", b",") and (97 <= run[-2:-1][0] <= 122 if len(run) > 1 else False):
                steps = self.run_steps(run[:-1]) + b"\x01"
            else:
                counts = self.run_counts(run.decode())
                steps = bytes([(b - a) & 255 for a, b in zip([0, *counts], counts, strict=False)])
            self.steps_of[run] = steps
        return steps

    def steps(self, text: str) -> bytes:
        """Difference of the counts of neighbouring prefixes, a signed byte per code point."""
        raw = text.encode()
        if b"<|" not in raw:
            raw = raw.lower()
        runs = raw.split()
        known = self.steps_of.get
        parts = [known(r) or self.run_steps(r) for r in runs]
        out = b"\x00".join(parts)
        if len(out) != len(text):
            at, pieces = 0, []
            for found in regex.finditer(rb"[^ \t\n\x0b\f\r]+", raw):
                pieces.append(bytes(found.start() - at))
                pieces.append(self.run_steps(found.group()))
                at = found.end()
            out = b"".join([*pieces, bytes(len(raw) - at)])
        return out

    def tidy(self) -> None:
        trim(self.steps_of)
        if self.nodes > FULL:
            self.forget()


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def prefix_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """`doc_id, n_bytes, n_tokens, prefix_steps` of every whole text."""
    ship(docs.sparkSession)
    name = path or vocabulary_path()
    kind = "doc_id long, n_bytes long, n_tokens long, prefix_steps binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # the tables are large and hold no cycles; scanning them costs a third
        own = counter(name)
        for batch in batches:
            ids, size, tokens, steps, held = [], [], [], [], 0
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                text = text.as_py() or ""
                found = own.steps(text)
                ids.append(doc.as_py())
                size.append(len(text.encode()))
                tokens.append(int(np.frombuffer(found, np.int8).sum(dtype=np.int64)))
                steps.append(found)
                held += len(found)
                if held > BATCH_CHARS:
                    yield made(ids, size, tokens, steps)
                    ids, size, tokens, steps, held = [], [], [], [], 0
                    own.tidy()
            own.tidy()
            yield made(ids, size, tokens, steps)

    def made(ids, size, tokens, steps) -> pa.RecordBatch:
        return pa.record_batch({
            "doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array(size, pa.int64()),
            "n_tokens": pa.array(tokens, pa.int64()), "prefix_steps": pa.array(steps, pa.binary())})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, kind)


def tokens_before(steps: Column, n_chars: Column) -> Column:
    """Exact token count of the prefix of `n_chars` code points."""

    def ask(held, wanted):
        import pandas as pd

        return pd.Series([
            int(np.frombuffer(s, np.int8)[: max(0, int(n))].sum(dtype=np.int64))
            for s, n in zip(held, wanted, strict=True)])

    return F.pandas_udf(ask, "long")(steps, n_chars)


def longest_within(steps: Column, budget: Column) -> Column:
    """Code points of the longest prefix that has at most `budget` tokens."""

    def ask(held, wanted):
        import pandas as pd

        out = []
        for s, n in zip(held, wanted, strict=True):
            counts = np.cumsum(np.frombuffer(s, np.int8), dtype=np.int64)
            good = np.flatnonzero(counts <= n)
            out.append(int(good[-1]) + 1 if len(good) else 0)
        return pd.Series(out)

    return F.pandas_udf(ask, "long")(steps, budget)
