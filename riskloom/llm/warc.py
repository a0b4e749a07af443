"""WARC archives: a writer that stores equal payloads once, and a splittable reader.

Writer: payload digests are compared first, so that of equal payloads the record of the largest id holds the payload
and the others are revisits. A task writes its records as gzip members of one file in the shared folder and returns the
file's name; the list of files is itself a table, so only files of tasks that succeeded are ever read, whatever failed
or ran twice.

Reader: files are cut into byte ranges. A task looks for gzip magic in its range, takes a candidate for a member when
its first bytes decode to a WARC version line, and reads every member that starts inside its range to its end, which
may lie beyond. Members that do not start a WARC record are passed over. Files open through pyarrow, which knows local
and remote stores by the scheme of the path.

Defined results: a null payload is empty; null ids and urls are left out of the header and read back null; of records
with equal payloads that share the largest id all are responses; an empty table gives no files and no records.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import lookup, stored
from riskloom.session import shared_folder

MIN_REVISIT = 1000
RANGE = 8 << 20
VERSION = b"WARC/1.1\r\n"
MAGIC = b"\x1f\x8b\x08"
DATE = "1970-01-01T00:00:00Z"  # tables carry no time of capture
_STEP = 1 << 18
_HEAD = 96


def _path(name: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(name) if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", name) else (fs.LocalFileSystem(), name)


def header(kind: str, key: int | None, url: str | None, digest: str, size: int, held: int, refers: int | None) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key}/{digest}')}>"), ("WARC-Date", DATE)]
    lines += [("WARC-Target-URI", " ".join(url.split()))] if url is not None else []
    lines += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", size)]
    lines += [("X-Row-ID", key)] if key is not None else []
    if kind == "revisit":
        lines += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Row-ID", refers)]
    lines += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", held)]
    return VERSION + "".join(f"{a}: {b}\r\n" for a, b in lines).encode() + b"\r\n"


def member(head: bytes, payload: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(head) + pack.compress(payload) + pack.compress(b"\r\n\r\n") + pack.flush()


def revisits(pages: DataFrame) -> DataFrame:
    """(row, refers) of the records that revisit another; ``pages`` has row, id, body."""
    own = stored(pages.filter(F.octet_length("body") >= MIN_REVISIT).select("row", "id", F.octet_length("body").alias("size"), F.sha1("body").alias("digest"))
                 .select("row", "id", F.concat_ws("-", "digest", "size").alias("payload")), "payloads")
    groups = stored(own.groupBy("payload").agg(F.max("id").alias("refers"), F.count("*").alias("copies")).filter("copies > 1"), "copies")
    total = groups.agg(F.sum("copies")).first()[0] or 0
    return lookup(own, groups, "payload", "copies", total).filter("NOT (id <=> refers) AND refers IS NOT NULL").select("row", "refers")


def write(df: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the archive below ``folder``; returns the stored list of its files: name, bytes, records.

    Payloads are compressed before they meet the decisions, and the records are written as they come from that join.
    """
    pages = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{url}`").alias("url"),
                      F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary").alias("body"))
    marks = [F.xxhash64(F.lit(seed), F.col("id").isNull(), "id", F.col("url").isNull(), "url", "body") for seed in (1, 2)]
    pages = pages.withColumn("row", F.concat_ws("-", *[F.hex(m) for m in marks]))  # 128 bits tell rows apart
    found = stored(revisits(pages).distinct(), "revisits")

    def responses(batches):
        for batch in batches:
            rows = []
            for row, key, url, body in zip(*(c.to_pylist() for c in batch.columns)):
                digest = hashlib.sha1(body).hexdigest()
                rows.append((row, key, url, len(body), digest, member(header("response", key, url, digest, len(body), len(body), None), body)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["row", "id", "url", "size", "digest", "member"])

    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    made = pages.select("row", "id", "url", "body").mapInArrow(responses, "row string, id long, url string, size long, digest string, member binary")

    def files(batches):
        store = out = name = None
        written = records = 0
        for batch in batches:
            for key, url, size, digest, held, refers in zip(*(batch.column(batch.schema.names.index(c)).to_pylist()
                                                              for c in ("id", "url", "size", "digest", "member", "refers"))):
                if out is None:
                    store, below = _path(folder)
                    store.create_dir(below, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{below}/{name}", compression=None)
                if refers is not None:
                    held = member(header("revisit", key, url, digest, size, 0, refers), b"")
                out.write(held)
                written += len(held)
                records += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"name": [f"{folder}/{name}"], "bytes": [written], "records": [records]})

    ready = made.join(found, "row", "left")
    return stored(ready.mapInArrow(files, "name string, bytes long, records long"), "archive")


class _Members:
    """Gzip members of a file that start in [start, stop)."""

    def __init__(self, source, size: int, start: int, stop: int):
        self.source, self.size, self.start, self.stop = source, size, start, min(stop, size)
        self.base, self.held = start, b""

    def _bytes(self, at: int, least: int) -> bytes:
        """At least ``least`` bytes from ``at`` on, fewer at the end of the file."""
        if at < self.base or at > self.base + len(self.held):
            self.base, self.held = at, b""
        else:
            self.held, self.base = self.held[at - self.base :], at
        if len(self.held) < least:
            self.source.seek(self.base + len(self.held))
            self.held += self.source.read(max(least - len(self.held), _STEP))
        return self.held

    def _starts(self, at: int) -> bool:
        try:
            return zlib.decompressobj(31).decompress(self._bytes(at, 1 << 12)[: 1 << 12], _HEAD).startswith(b"WARC/1.")
        except zlib.error:
            return False

    def __iter__(self):
        at = self.start
        while at < self.stop:
            held = self._bytes(at, _STEP)
            k = held.find(MAGIC)
            if k < 0:
                at += max(1, len(held) - len(MAGIC) + 1)
                if len(held) < len(MAGIC):
                    return
                continue
            at += k
            if at >= self.stop:
                return
            if not self._starts(at):
                at += 1
                continue
            whole = self._member(at)
            if whole is None:
                at += 1
                continue
            content, at = whole
            yield content

    def _member(self, at: int):
        pack, out, here = zlib.decompressobj(31), [], at
        try:
            while not pack.eof:
                held = self._bytes(here, 1)
                if not held:
                    return None  # cut off
                out.append(pack.decompress(held))
                here += len(held) - len(pack.unused_data)
                self.base, self.held = here, pack.unused_data
        except zlib.error:
            return None
        return b"".join(out), here


def parse(content: bytes):
    """(headers, payload) of each record in a member's content."""
    at = 0
    while content.startswith(b"WARC/1.", at):
        end = content.index(b"\r\n\r\n", at)
        headers = {}
        for line in content[at:end].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            headers[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
        size = int(headers.get("content-length", 0))
        yield headers, content[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def read(spark: SparkSession, files: DataFrame, range_bytes: int = RANGE) -> DataFrame:
    """Records of the files listed with ``name`` and ``bytes``: row_id, url, record_type, payload (null in revisits),
    payload_bytes and payload_digest (of the full payload), refers_to."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
    tasks = files.filter("bytes > 0").select("name", "bytes", starts.alias("start"))
    ranges = files.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 1
    tasks = tasks.repartition(int(ranges), F.xxhash64("name", "start"))  # a stated number: small rows, but long tasks
    schema = pa.schema([("row_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])

    def records(batches):
        number = lambda x: None if x is None else int(x)
        for batch in batches:
            for name, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                store, below = _path(name)
                rows, held = [], 0
                with store.open_input_file(below) as source:
                    for content in _Members(source, size, start, start + range_bytes):
                        for h, payload in parse(content):
                            whole = h.get("warc-type") != "revisit"
                            digest = hashlib.sha1(payload).hexdigest() if whole else h.get("warc-payload-digest", "").partition(":")[2]
                            rows.append((number(h.get("x-row-id")), h.get("warc-target-uri"), h.get("warc-type"), payload if whole else None,
                                         len(payload) if whole else number(h.get("x-payload-length")), digest, number(h.get("x-refers-to-row-id"))))
                            held += len(payload)
                        if held > 1 << 24:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return tasks.mapInArrow(records, "row_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long")


def archive(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the rows to a new archive in the shared folder and read it back."""
    spark = df.sparkSession
    files = write(df, shared_folder(spark, "warc"), key, url, html)
    return read(spark, files)
