"""Token ids in binary shards, compressed by a Re-Pair grammar.

Documents are ordered by id over range partitions, encoded, and gathered into shards. In a shard,
id pairs that occur often are replaced by nonterminals, again and again until no pair is frequent.
Each round takes all frequent pairs at once; where two overlap the one that occurs more often wins,
and a pair that loses so many places that its rule would not pay is left as it is. A shard file
holds the rules, their expansion lengths, and for every document where its symbols begin, so one
document is decoded by reading the head, the rules and its own symbols. No rule crosses the end of a
document.

Files are written under names of their own by each attempt; the index table, committed by Spark,
names the ones that count, so lost and repeated tasks leave no trace in the result.

File: `RPR2`, seven counts (documents, rules, symbols, bits of a symbol, bits of a length, ids that
occur, bytes of their bitmap) as 64-bit integers; ids of documents (64-bit) and a byte each that
tells missing ids; first symbol of each document and the end (64-bit); a bitmap of the ids that
occur; then bit-packed, each from a byte of its own: left sides, right sides and expansion lengths of
the rules, and the symbols. The first symbols are the ids that occur, in order; rules follow them.
Integers are little-endian, packed bits begin with the highest.

Defined cases: a NULL or empty text has just the end id. Missing ids come first; rows with equal
ids are ordered by their text's hash, then text. Special strings inside texts are special tokens.
A document of any length is one part of one shard. An empty table writes no shard and has no rows.
Other columns are ignored.
"""

from __future__ import annotations

import gc
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import open_store, scratch, ship, stored
from logloom.llm.tokens import PARTS, trim, vocabulary_path

END_ID = 1
SHARD_TOKENS = 400_000
#: A pair is frequent if it occurs so often in its shard.
FREQUENT = 12
#: A rule pays if it is used so often.
USED = 4
MAGIC = b"RPR2"
#: Entries of a worker's table of runs; those met first stay when it is full.
KEEP, FULL = 1_000_000, 2_000_000
SLOT_BITS = 18
#: Marks the last symbol of a document.
LAST = np.uint32(1 << 31)
#: New runs encoded as one text.
TOGETHER = 512
#: Bytes of the texts encoded at a time, one text at least.
CHUNK_BYTES = 4_000_000


class Encoder:
    """Ids of whole texts, with the ids of runs between ASCII white space kept for reuse.

    Texts are cut into runs as one array of bytes, and equal runs of a chunk are looked up once. A
    run ends at white space and where a lower-case letter of Latin-1 meets ASCII punctuation: there
    the pre-tokenizer cuts too and no characters compose. An apostrophe is not cut from the letters
    after it (contractions), and texts that may hold a special token are cut at white space only.

    New runs are encoded together, with spaces between them: a run of letters in composed form is
    one piece of the pre-tokenizer, and the pieces of an ASCII run can be counted. The last token of
    a piece carries the end mark, so the ids are cut at these.
    """

    END = "</w>"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closes[[n for token, n in vocabulary.items() if token.endswith(self.END)]] = True
        #: Number of a run; its ids are flat[starts[number] : starts[number + 1]], run 0 is the end id.
        self.known: dict[bytes, int] = {b"": 0}
        self.flat = np.array([END_ID], dtype=np.uint32)
        self.starts = np.array([0, 1], dtype=np.int64)

    def keep(self, runs: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        held = len(self.known)
        begin = int(self.starts[held])
        self.known.update(zip(runs, range(held, held + len(runs)), strict=True))
        self.flat = longer(self.flat, begin + len(ids))
        self.flat[begin : begin + len(ids)] = ids
        self.starts = longer(self.starts, held + len(runs) + 1)
        self.starts[held + 1 : held + len(runs) + 1] = begin + np.cumsum(sizes)

    def learn(self, runs: list[bytes], letters: list[bool]) -> None:
        """Encode new runs; those of `letters` are one piece each."""
        pieces = [1 if one else self.pieces(r) for r, one in zip(runs, letters, strict=True)]
        other = [r for r, n in zip(runs, pieces, strict=True) if not n]
        sure = [r for r, n in zip(runs, pieces, strict=True) if n]
        pieces = [n for n in pieces if n]
        for low in range(0, len(sure), TOGETHER):
            other += self.learn_together(sure[low : low + TOGETHER], pieces[low : low + TOGETHER])
        found = self.library.encode_batch_fast([r.decode() for r in other], add_special_tokens=False)
        ids = [f.ids for f in found]
        self.keep(other, np.array([n for own in ids for n in own], dtype=np.uint32),
                  np.array([len(own) for own in ids], dtype=np.int64))

    @staticmethod
    def pieces(run: bytes) -> int:
        """Pieces of the pre-tokenizer in a run, 0 if only the library can tell."""
        if run.isalpha():
            return 1
        if run.isascii():
            return 0 if b"<|" in run else len(PARTS.findall(run.decode()))
        text = run.decode()
        return int(text.isalpha() and unicodedata.is_normalized("NFC", text))

    def learn_together(self, runs: list[bytes], pieces: list[int]) -> list[bytes]:
        """Encode the runs as one text and cut its ids; the runs if their pieces do not add up."""
        (found,) = self.library.encode_batch_fast(
            [b" ".join(runs).decode()], add_special_tokens=False)
        ids = np.array(found.ids, dtype=np.uint32)
        after = np.flatnonzero(self.closes[ids]) + 1
        if len(after) != sum(pieces):
            return runs
        self.keep(runs, ids, np.diff(after[np.cumsum(pieces) - 1], prepend=0))
        return []

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, the end id after each, and where each text's ids end."""
        trim(self.known, KEEP, FULL)
        offsets, raw = bytes_of(texts)
        at, data, closing = runs_of(offsets, raw)
        coded = pa.Array.from_buffers(pa.binary(), len(at) - 1, [
            None, pa.py_buffer(at), pa.py_buffer(data)]).dictionary_encode()
        runs = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = list(map(self.known.get, runs))
        new = [n for n, number in enumerate(numbers) if number is None]
        if new:
            at, held = bytes_of(coded.dictionary)
            odd = np.append(0, np.cumsum(kinds_of(held) != LETTER, dtype=np.int32))[at]
            letters = np.diff(odd) == 0
            self.learn([runs[n] for n in new], letters[new].tolist())
            numbers = list(map(self.known.get, runs))
        # a run for each text's end, after its own
        number = np.insert(np.array(numbers, dtype=np.int64)[coded.indices.to_numpy()], closing, 0)
        sizes = self.starts[number + 1] - self.starts[number]
        ends = np.cumsum(sizes)[closing + np.arange(len(closing))]
        return gathered(self.flat, self.starts[number], sizes), ends


#: Kinds of bytes: white space, part of a lower-case letter of ASCII or Latin-1 (after lowering A to
#: Z), ASCII punctuation, the apostrophe, any other.
WHITE, LETTER, MARK, APOSTROPHE, OTHER = range(5)
KINDS = np.full(256, OTHER, dtype=np.uint8)
KINDS[[9, 10, 11, 12, 13, 32]] = WHITE
KINDS[[n for n in range(128) if chr(n).isalpha()]] = LETTER
KINDS[[n for n in range(33, 127) if not chr(n).isalnum()]] = MARK
KINDS[ord("'")] = APOSTROPHE
LOWERED = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)
#: Second bytes of the lower-case letters of Latin-1, after byte C3.
SECOND = np.isin(np.arange(256), [n for n in range(0x9F, 0xC0) if n != 0xB7])
#: Whether a run begins at the second of two kinds, first * 8 + second.
BEGINS = np.zeros(64, dtype=bool)
BEGINS[[WHITE * 8 + kind for kind in (LETTER, MARK, APOSTROPHE, OTHER)]] = True
BEGINS[[LETTER * 8 + MARK, LETTER * 8 + APOSTROPHE, MARK * 8 + LETTER]] = True


def longer(array: np.ndarray, size: int) -> np.ndarray:
    """The array with room for so many values, half as many again at least if it grows."""
    if len(array) >= size:
        return array
    wide = np.empty(max(size, len(array) * 3 // 2), dtype=array.dtype)
    wide[: len(array)] = array
    return wide


def bytes_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 on and bytes of an array of strings; NULL is empty."""
    values = values.cast(pa.large_binary())
    if values.null_count:
        values = values.fill_null(b"")
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    raw = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
    return offsets - offsets[0], raw


def kinds_of(raw: np.ndarray) -> np.ndarray:
    kinds = KINDS[raw]
    pair = np.flatnonzero(raw[:-1] == 0xC3)
    pair = pair[SECOND[raw[pair + 1]]]
    kinds[pair] = kinds[pair + 1] = LETTER
    return kinds


def runs_of(offsets: np.ndarray, raw: np.ndarray) -> tuple:
    """(where each run begins and the last ends in `data`, `data`: bytes of all runs, number of
    runs up to each text's end)."""
    kinds, lowered = kinds_of(raw), LOWERED[raw]
    word = kinds != WHITE
    begin = word.copy()
    begin[1:] = BEGINS[(kinds[:-1] << 3) | kinds[1:]]
    bars = np.flatnonzero((raw[:-1] == ord("<")) & (raw[1:] == ord("|")))
    for text in np.unique(np.searchsorted(offsets, bars, "right") - 1).tolist():
        own = slice(int(offsets[text]), int(offsets[text + 1]))
        lowered[own] = raw[own]
        begin[own][1:] = word[own][1:] & ~word[own][:-1]
    edge = offsets[offsets < len(raw)]
    begin[edge] = word[edge]
    first = np.flatnonzero(begin)
    data = lowered[word]
    # white space is left out of the data
    at = np.append(first - np.cumsum(~word, dtype=np.int32)[first], len(data))
    return at.astype(np.int32), data, np.searchsorted(first, offsets[1:])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def chosen_pairs(symbols: np.ndarray, newest: int) -> tuple:
    """(places, rule of each place, codes of the rules, their counts) of pairs that occur often.

    The frequent pairs of the round before have been replaced or broken up, and counts of old
    pairs only fall, so a pair is looked for only if it has a symbol made since: `newest` on.
    A table of hashed counts leaves the pairs that may be frequent; these are counted exactly.
    """
    inner = symbols[:-1] < LAST
    if newest:
        fresh = (symbols & ~LAST) >= newest
        inner &= fresh[:-1] | fresh[1:]
    inside = np.flatnonzero(inner)
    code = (symbols[inside].astype(np.uint64) << np.uint64(32)) | (symbols[inside + 1] & ~LAST)
    if len(inside) > 1 << SLOT_BITS - 4:
        slot = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)
        slot = slot.astype(np.int32)
        may = np.flatnonzero((np.bincount(slot, minlength=1 << SLOT_BITS) >= FREQUENT)[slot])
        inside, code = inside[may], code[may]
    rules, rule, count = np.unique(code, return_inverse=True, return_counts=True)
    often = count >= FREQUENT
    good = np.flatnonzero(often[rule])
    return inside[good], (np.cumsum(often) - 1)[rule[good]], rules[often], count[often]


def apart(place: np.ndarray, rule: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Which of the ascending places are taken, none beside another; frequent pairs go first.

    Of neighbours the pair with the higher count wins, of equal pairs the first, third, ... of a
    run. What lies between the winners is looked at again, until every place is taken or beside one.
    """
    taken = np.zeros(len(place), dtype=bool)
    strength = np.empty(len(count), dtype=np.int64)
    strength[np.argsort(count, kind="stable")] = np.arange(len(count))
    strength = strength[rule]
    open_ones = np.arange(len(place))
    while len(open_ones):
        at, power = place[open_ones], strength[open_ones]
        joined = np.diff(at) == 1
        same = joined & (np.diff(power) == 0)
        rising = joined & (np.diff(power) > 0)
        falling = joined & (np.diff(power) < 0)
        # runs of one pair stand and fall together
        begin = np.append(0, np.flatnonzero(~same) + 1)
        end = np.append(begin[1:], len(at)) - 1
        beaten = np.zeros(len(begin), dtype=bool)
        beaten[1:] |= falling[begin[1:] - 1]
        beaten[:-1] |= rising[end[:-1]]
        size = end - begin + 1
        offset = np.arange(len(at)) - np.repeat(begin, size)
        won = (offset % 2 == 0) & ~np.repeat(beaten, size)
        taken[open_ones[won]] = True
        left = np.repeat(beaten, size)
        left[:-1] &= ~(joined & won[1:])
        left[1:] &= ~(joined & won[:-1])
        open_ones = open_ones[left]
    return taken


def compressed(ids: np.ndarray, ends: np.ndarray, first: int) -> tuple:
    """(symbols, last flags, left sides, right sides, rounds); nonterminals count from `first`."""
    symbols = ids.astype(np.uint32)
    symbols[ends - 1] |= LAST
    lefts, rights, rounds = [], [], []
    made = 0
    while len(symbols) > 1:
        place, rule, rules, count = chosen_pairs(
            symbols, first + made - rounds[-1] if rounds else 0)
        if not len(place):
            break
        take = apart(place, rule, count)
        place, rule = place[take], rule[take]
        pays = np.bincount(rule, minlength=len(rules)) >= USED
        if not pays.any():
            break
        take = pays[rule]
        place, rule, rules = place[take], (np.cumsum(pays) - 1)[rule[take]], rules[pays]
        symbols[place] = (first + made + rule).astype(np.uint32) | (symbols[place + 1] & LAST)
        keep = np.ones(len(symbols), dtype=bool)
        keep[place + 1] = False
        symbols = symbols[keep]
        lefts.append((rules >> np.uint64(32)).astype(np.uint32))
        rights.append((rules & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        rounds.append(len(rules))
        made += len(rules)
    join = lambda x: np.concatenate(x) if x else np.zeros(0, dtype=np.uint32)
    return symbols & ~LAST, symbols >= LAST, join(lefts), join(rights), rounds


def bits_for(largest: int) -> int:
    return max(1, int(largest).bit_length())


def packed(values: np.ndarray, bits: int) -> bytes:
    """The lowest `bits` bits of each value, one after another."""
    width = 16 if bits <= 16 else 32
    raw = values.astype(f">u{width // 8}").view(np.uint8).reshape(-1, width // 8)
    return np.packbits(np.unpackbits(raw, axis=1)[:, width - bits :]).tobytes()


def packed_size(count: int, bits: int) -> int:
    return (count * bits + 7) // 8


def unpacked(raw: bytes, count: int, bits: int, skip: int = 0) -> np.ndarray:
    """`count` values of `bits` bits, after the first `skip` bits."""
    flat = np.unpackbits(np.frombuffer(raw, np.uint8))[skip : skip + count * bits]
    width = 16 if bits <= 16 else 32
    wide = np.zeros((count, width), dtype=np.uint8)
    wide[:, width - bits :] = flat.reshape(count, bits)
    return np.packbits(wide).view(f">u{width // 8}").astype(np.uint32)


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches flat[start : start + size], one after another."""
    ends = np.cumsum(sizes)
    if not len(sizes) or not ends[-1]:
        return flat[:0]
    return flat[np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)]


class Grammar:
    """Expansions of a shard's symbols: first the ids that occur, then the rules."""

    def __init__(self, terminals: np.ndarray, left: np.ndarray, right: np.ndarray,
                 sizes: np.ndarray):
        first = len(terminals)
        self.sizes = np.concatenate([np.ones(first, dtype=np.int64), sizes.astype(np.int64)])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.zeros(int(self.sizes.sum()), dtype=np.uint32)
        self.flat[:first] = terminals
        done = 0
        while done < len(left):
            # the longest stretch of rules whose sides are known already
            high = np.maximum(left[done:], right[done:]).astype(np.int64) - first
            unknown = np.flatnonzero(high >= done)
            upto = done + int(unknown[0]) if len(unknown) else len(left)
            sides = np.stack([left[done:upto], right[done:upto]], axis=1).ravel()
            own = self.expanded(sides)
            at = int(self.starts[first + done])
            self.flat[at : at + len(own)] = own
            done = upto

    def lengths(self, symbols: np.ndarray) -> np.ndarray:
        return self.sizes[symbols]

    def expanded(self, symbols: np.ndarray) -> np.ndarray:
        return gathered(self.flat, self.starts[symbols], self.sizes[symbols])


def shard_bytes(docs: list[int | None], parts: list[np.ndarray]) -> bytes:
    ids = np.concatenate(parts)
    ends = np.cumsum([len(p) for p in parts])
    occurs = np.bincount(ids) > 0
    terminals = int(occurs.sum())
    number = np.cumsum(occurs) - 1
    symbols, last, left, right, _ = compressed(number[ids], ends, terminals)
    sizes = [1] * terminals
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        sizes.append(sizes[a] + sizes[b])
    lengths = np.array(sizes[terminals:], dtype=np.uint32)
    begins = np.concatenate([[0], np.flatnonzero(last) + 1]).astype("<i8")
    bits, length_bits = bits_for(terminals + len(left) - 1), bits_for(max(sizes))
    bitmap = np.packbits(occurs)
    head = np.array([len(docs), len(left), len(symbols), bits, length_bits, terminals,
                     len(bitmap)], dtype="<i8")
    return b"".join([
        MAGIC, head.tobytes(),
        np.array([d or 0 for d in docs], dtype="<i8").tobytes(),
        np.array([d is None for d in docs], dtype=np.uint8).tobytes(),
        begins.tobytes(), bitmap.tobytes(), packed(left, bits), packed(right, bits),
        packed(lengths, length_bits), packed(symbols, bits)])


class Shard:
    """Random access to the documents of one shard file."""

    def __init__(self, file):
        self.file = file
        size = len(MAGIC) + 56
        head = self.part(0, size)
        if head[:4] != MAGIC:
            raise ValueError("not a shard")
        docs, rules, self.symbols, self.bits, length_bits, terminals, bitmap = np.frombuffer(
            head[4:], "<i8").tolist()
        side, length = packed_size(rules, self.bits), packed_size(rules, length_bits)
        body = self.part(size, docs * 17 + 8 + bitmap + 2 * side + length)
        self.ids = np.frombuffer(body, "<i8", docs)
        self.missing = np.frombuffer(body, np.uint8, docs, docs * 8)
        self.begins = np.frombuffer(body, "<i8", docs + 1, docs * 9)
        at = docs * 17 + 8
        occurs = np.flatnonzero(np.unpackbits(np.frombuffer(body, np.uint8, bitmap, at)))
        at += bitmap
        left = unpacked(body[at : at + side], rules, self.bits)
        right = unpacked(body[at + side : at + 2 * side], rules, self.bits)
        sizes = unpacked(body[at + 2 * side :], rules, length_bits)
        self.grammar = Grammar(occurs[:terminals], left, right, sizes)
        self.at = size + len(body)

    def part(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)

    def __len__(self) -> int:
        return len(self.ids)

    def doc_id(self, n: int) -> int | None:
        return None if self.missing[n] else int(self.ids[n])

    def symbols_of(self, low: int, high: int) -> np.ndarray:
        begin = low * self.bits
        raw = self.part(self.at + begin // 8, packed_size(high * self.bits, 1) - begin // 8)
        return unpacked(raw, high - low, self.bits, begin % 8)

    def document(self, n: int) -> np.ndarray:
        """Ids of document `n`, from its own symbols and the rules."""
        return self.grammar.expanded(self.symbols_of(int(self.begins[n]), int(self.begins[n + 1])))

    def documents(self) -> Iterator[np.ndarray]:
        """Ids of all documents, symbols read and expanded in one go."""
        symbols = self.symbols_of(0, self.symbols)
        ids = self.grammar.expanded(symbols)
        ends = np.concatenate([[0], np.cumsum(self.grammar.lengths(symbols))])[self.begins]
        for low, high in zip(ends[:-1], ends[1:], strict=True):
            yield ids[low:high]


def write(docs: DataFrame, folder: str, path: str | None = None) -> DataFrame:
    """Write the shards; their index: `part, shard, file, n_docs, n_tokens, n_bytes`.

    `part` and `shard` order the shards as the documents are ordered.
    """
    spark = docs.sparkSession
    ship(spark)
    name = path or vocabulary_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        gc.disable()  # the table of runs is large and holds no cycles
        part, own, number = TaskContext.get().partitionId(), encoder(name), 0
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        ids: list = []
        parts: list = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, parts, held, number
            file = f"{part:06d}-{number:06d}-{uuid.uuid4().hex}.rpr"
            content = shard_bytes(ids, parts)
            with store.open_output_stream(f"{base}/{file}") as out:
                out.write(content)
            row = pa.record_batch({
                "part": pa.array([part], pa.int32()), "shard": pa.array([number], pa.int32()),
                "file": [file], "n_docs": pa.array([len(ids)], pa.int64()),
                "n_tokens": pa.array([held], pa.int64()),
                "n_bytes": pa.array([len(content)], pa.int64())})
            ids, parts, held, number = [], [], 0, number + 1
            return row

        for batch in batches:
            texts = batch["text"]
            offsets, _ = bytes_of(texts)
            docs = batch["doc_id"].to_pylist()
            low = 0
            while low < len(docs):
                upto = int(np.searchsorted(offsets, offsets[low] + CHUNK_BYTES, "right")) - 1
                upto = max(upto, low + 1)
                found, ends = own.encode(texts.slice(low, upto - low))
                for doc, tokens in zip(docs[low:upto], np.split(found, ends[:-1]), strict=True):
                    ids.append(doc)
                    parts.append(tokens)
                    held += len(tokens)
                    if held >= SHARD_TOKENS:
                        yield flush()
                low = upto
        if ids:
            yield flush()

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.withColumn("_hash", F.xxhash64("text")).repartitionByRange(
        tasks, F.col("doc_id").asc_nulls_first(), "_hash")
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_hash", "text")
    return stored(rows.select("doc_id", "text").mapInArrow(
        encode, "part int, shard int, file string, n_docs long, n_tokens long, n_bytes long"), "shards")


def starts(index: DataFrame) -> DataFrame:
    """`index` with `base`, the ids in all shards before: sums of parts, then within a part."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("all")).select(
        "part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("of_parts"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1)
    own = index.withColumn("of_part", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return own.join(parts, "part").select(
        "file", (F.col("of_parts") + F.col("of_part")).alias("base"))


def read(index: DataFrame, folder: str) -> DataFrame:
    """Every document, decoded: `doc_id, start, n_tokens, ids_crc32`."""
    ship(index.sparkSession)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        for batch in batches:
            for file, at in zip(batch["file"].to_pylist(), batch["base"].to_pylist(), strict=True):
                ids, begin, count, crc = [], [], [], []
                with store.open_input_file(f"{base}/{file}") as source:
                    shard = Shard(source)
                    for n, tokens in enumerate(shard.documents()):
                        ids.append(shard.doc_id(n))
                        begin.append(at)
                        count.append(len(tokens))
                        crc.append(zlib.crc32(tokens.astype("<u4", copy=False)))
                        at += len(tokens)
                yield pa.record_batch({
                    "doc_id": pa.array(ids, pa.int64()), "start": pa.array(begin, pa.int64()),
                    "n_tokens": pa.array(count, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64())})

    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return starts(index).repartition(tasks).mapInArrow(
        decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write all documents to a new folder and read them back."""
    folder = scratch(docs.sparkSession, "tokens")
    return read(write(docs, folder, path), folder)
