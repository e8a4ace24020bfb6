"""WARC archives with a two-level capture index.

Pages become WARC/1.1 records, each a gzip member of its own, in archive files of bounded size. Of
records with equal payloads of at least `REVISIT_BYTES` bytes, the one with the largest page id is
a response and the others are revisits without payload.

The index has a line per record, sorted by reversed-host URL key. Lines are cut into blocks, each
compressed by itself; a sparse directory keeps first and last key, file, offset and length of
every block. A lookup binary-searches the part of the directory that its keys span, reads the
blocks by range, then the records by range.

Tasks write files under names of their own; the tables that Spark commits name the ones that
count. Everything is in one folder that all executors share.

Defined cases: NULL html is an empty payload; a NULL url has the key `-` and no target header; a
NULL page id is written empty and read back as NULL. Rows with equal page id and payload are all
alike: all responses or all revisits. Keys shared by many pages spread over the blocks they fill.
An empty table writes nothing and gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import open_store, scratch, ship, stored
from logloom.operators.lookup import lookup_join

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 128 << 20
LINES_PER_BLOCK = 1024
LEVEL = 4
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
URL_PARTS = re.compile(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(:\d+)?(.*)", re.S)


def url_key(url: str | None) -> str:
    """Host labels reversed and joined by commas, port, `)`, then the rest: `com,example)/a?b`."""
    if not url:
        return "-"
    found = URL_PARTS.fullmatch(url)
    if not found:
        return re.sub(r"[\t\r\n]", " ", url)
    host, port, rest = found.groups()
    labels = host.lower().removeprefix("www.").split(".")
    port = "" if port in (None, ":80", ":443") else port
    return re.sub(r"[\t\r\n]", " ", ",".join(reversed(labels)) + port + ")" + (rest or "/"))


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page}/{digest}')}>"


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None,
           revisit: bool) -> bytes:
    """One record as a gzip member."""
    digest = hashlib.sha1(payload).hexdigest()
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
            % len(payload))
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: {record_id(page, digest)}", f"WARC-Date: {DATE}"]
    if url:
        lines.append("WARC-Target-URI: " + re.sub(r"[\r\n]", " ", url))
    name = base64.b32encode(bytes.fromhex(digest)).decode()
    lines += [f"WARC-Payload-Digest: sha1:{name}", f"X-Page-Id: {'' if page is None else page}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}",
                  f"X-Refers-To-Page-Id: {'' if refers_to is None else refers_to}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    whole = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(whole) + packer.flush()


def parsed(member: bytes) -> dict:
    """Headers, HTTP headers and payload of a record."""
    whole = zlib.decompress(member, 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    return {"headers": headers, "http": fields, "payload": payload}


def payload_of(html: Column) -> Column:
    return F.coalesce(html, F.lit(""))


def with_revisits(pages: DataFrame) -> DataFrame:
    """`page_id, url, html` with `revisit` and `refers_to`."""
    digest = F.sha1(payload_of(F.col("html")))
    size = F.octet_length(payload_of(F.col("html")))
    name = F.concat_ws("/", digest, size, F.coalesce(F.col("page_id").cast("string"), F.lit("-")))
    thin = stored(pages.filter(size >= REVISIT_BYTES).select(
        "page_id", digest.alias("digest"), size.alias("size"), name.alias("same")), "digests")
    chosen = thin.groupBy("digest", "size").agg(
        F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    revisits = thin.join(chosen, ["digest", "size"]).filter(
        ~F.col("page_id").eqNullSafe(F.col("refers_to"))).select(
        "same", "refers_to", F.lit(True).alias("revisit")).distinct()
    rows = pages.select("page_id", "url", "html", F.when(size >= REVISIT_BYTES, name).alias("same"))
    return lookup_join(rows, revisits, ["same"], spread="page_id").select(
        "page_id", "url", "html", "refers_to", F.coalesce("revisit", F.lit(False)).alias("revisit"))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write the archives; one row per record: `key, page_id, file, offset, length`."""
    ship(pages.sparkSession)

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        out, file, at = None, "", 0
        try:
            for batch in batches:
                keys, ids, files, offsets, lengths = [], [], [], [], []
                for page, url, html, to, again in zip(
                        *(batch[c] for c in ("page_id", "url", "html", "refers_to", "revisit")),
                        strict=True):
                    member = record(page.as_py(), url.as_py(), (html.as_py() or "").encode(),
                                    to.as_py(), again.as_py())
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        file, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{base}/{file}", compression=None)
                    out.write(member)
                    keys.append(url_key(url.as_py()))
                    ids.append(page.as_py())
                    files.append(file)
                    offsets.append(at)
                    lengths.append(len(member))
                    at += len(member)
                yield pa.record_batch({
                    "key": pa.array(keys, pa.string()), "page_id": pa.array(ids, pa.int64()),
                    "file": pa.array(files, pa.string()), "offset": pa.array(offsets, pa.int64()),
                    "length": pa.array(lengths, pa.int64())})
        finally:
            if out is not None:
                out.close()

    rows = with_revisits(pages).withColumn("page_id", F.col("page_id").cast("long")).withColumn(
        "refers_to", F.col("refers_to").cast("long"))
    return stored(rows.mapInArrow(
        archive, "key string, page_id long, file string, offset long, length long"), "records")


def index(records: DataFrame, folder: str) -> str:
    """Write the sorted blocks below `folder`; returns the folder of their directory."""
    spark = records.sparkSession
    ship(spark)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        file, at, lines, rows = f"{uuid.uuid4().hex}.idx", 0, [], []

        def block(out) -> int:
            packed = zlib.compress("\n".join("\t".join(x) for x in lines).encode())
            out.write(packed)
            rows.append((lines[0][0], lines[-1][0], file, at, len(packed)))
            lines.clear()
            return len(packed)

        out = None
        for batch in batches:
            for line in zip(batch["key"].to_pylist(), batch["file"].to_pylist(),
                            batch["offset"].cast(pa.string()).to_pylist(),
                            batch["length"].cast(pa.string()).to_pylist(), strict=True):
                out = out or store.open_output_stream(f"{base}/{file}", compression=None)
                lines.append(line)
                if len(lines) == LINES_PER_BLOCK:
                    at += block(out)
        if lines:
            block(out)
        if out is not None:
            out.close()
        names = ("first_key", "last_key", "file", "offset", "length")
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
        yield pa.record_batch({
            n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(zip(names, kinds, strict=True))})

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = records.select("key", "file", "offset", "length").repartitionByRange(
        tasks, "key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    where = scratch(spark, "directory")
    lines.mapInArrow(pack, "first_key string, last_key string, file string, offset long, length long"
                     ).write.parquet(where)
    return where


def blocks_for(keys: DataFrame, directory: str) -> DataFrame:
    """`key, file, offset, length` of every index block that may hold a key, by binary search.

    Keys are dealt by range, so each batch needs the stretch of the directory that it spans.
    """
    ship(keys.sparkSession)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds

        store, base = open_store(directory)
        stated = ds.dataset(base, format="parquet", filesystem=store)
        for batch in batches:
            wanted = batch["key"].to_pylist()
            if not wanted:
                continue
            near = stated.to_table(filter=(ds.field("last_key") >= wanted[0])
                                   & (ds.field("first_key") <= wanted[-1]))
            blocks = sorted(zip(*(near[c].to_pylist() for c in (
                "first_key", "last_key", "file", "offset", "length")), strict=True))
            lasts = [b[1] for b in blocks]
            found = []
            for key in wanted:
                n = bisect.bisect_left(lasts, key)
                while n < len(blocks) and blocks[n][0] <= key:
                    found.append((key, *blocks[n][2:]))
                    n += 1
            yield pa.record_batch({
                "key": pa.array([x[0] for x in found], pa.string()),
                "file": pa.array([x[1] for x in found], pa.string()),
                "offset": pa.array([x[2] for x in found], pa.int64()),
                "length": pa.array([x[3] for x in found], pa.int64())})

    tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = keys.select("key").distinct().repartitionByRange(tasks, "key").sortWithinPartitions("key")
    return own.mapInArrow(search, "key string, file string, offset long, length long")


def captures(keys: DataFrame, folder: str, directory: str) -> DataFrame:
    """Every record of the keys, read from the archives through the index.

    `key, page_id, payload_bytes, payload_digest, record_type, refers_to, payload`; a revisit has
    the length and digest of the full payload, and no payload.
    """
    kind = ("key string, page_id long, payload_bytes long, payload_digest string, "
            "record_type string, refers_to long, payload binary")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        files: dict = {}
        held, lines = None, {}

        def part(file: str, offset: int, length: int) -> bytes:
            if file not in files:
                if len(files) > 64:
                    files.popitem()[1].close()
                files[file] = store.open_input_file(f"{base}/{file}")
            return files[file].read_at(length, offset)

        def number(text: str | None) -> int | None:
            return int(text) if text else None

        for batch in batches:
            out = []
            for key, file, offset, length in zip(*(batch[c].to_pylist() for c in (
                    "key", "file", "offset", "length")), strict=True):
                if held != (file, offset):
                    held, lines = (file, offset), {}
                    for line in zlib.decompress(part(file, offset, length)).decode().split("\n"):
                        name, *where = line.split("\t")
                        lines.setdefault(name, []).append(where)
                for archive, start, size in lines.get(key, ()):
                    got = parsed(part(archive, int(start), int(size)))
                    head, body = got["headers"], got["payload"]
                    again = head["WARC-Type"] == "revisit"
                    stated = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:"))
                    if not again and hashlib.sha1(body).digest() != stated:
                        raise ValueError("the payload does not have its digest")
                    out.append((key, number(head["X-Page-Id"]), int(got["http"]["Content-Length"]),
                                stated.hex(), head["WARC-Type"],
                                number(head.get("X-Refers-To-Page-Id")), None if again else body))
                    if len(out) == 512:
                        yield made(out)
                        out = []
            yield made(out)
        for file in files.values():
            file.close()

    def made(rows: list) -> pa.RecordBatch:
        kinds = {"key": pa.string(), "page_id": pa.int64(), "payload_bytes": pa.int64(),
                 "payload_digest": pa.string(), "record_type": pa.string(),
                 "refers_to": pa.int64(), "payload": pa.binary()}
        return pa.record_batch({n: pa.array([r[i] for r in rows], k)
                                for i, (n, k) in enumerate(kinds.items())})

    tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = blocks_for(keys, directory).repartition(tasks, "file", "offset").sortWithinPartitions(
        "file", "offset", "key")
    return found.mapInArrow(read, kind)


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive and index all pages in a new folder, then read all captures of their keys."""
    folder = scratch(pages.sparkSession, "warc")
    records = write(pages, folder)
    return captures(records.select("key"), folder, index(records, folder))
