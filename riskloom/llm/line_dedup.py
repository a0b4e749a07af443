"""Line dedup: repeated lines stay only in the document with the smallest id.

Method: two Bloom filters, one for hashes seen once and one for hashes seen twice. Every task notes the filter bits
its lines set and the bits they set again; merged by filter chunk, a bit set by two tasks counts as set twice. Only
lines all of whose bits were set twice are suspects and shuffle; a grouping of their 128-bit digests confirms true
repeats and picks the first document. The filters are cut into slices of the hash space, as many as the number of
lines asks for; one job merges all of them into the shared folder, where a task reads the filters of the slices whose
lines it holds, a few at a time. No filter passes through the driver.

Defined results: null and empty text is one empty line; null ids act as one document after all others; rows that
repeat an id are one document, each row filtered alike, and what a row loses is gathered for its own text; other columns pass through ``dedup_lines`` untouched.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import NO_ID, id_and_text, lookup, map_arrow, original_id, stored, unused
from riskloom.session import shared_folder

SPACE = b" \t\n\x0b\x0c\r"
MIN_CHARS = 10
#: Two bits a line are set among BITS_PER_LINE times as many; filters are merged in chunks of CHUNK bits.
BITS_PER_LINE, CHUNK = 16, 1 << 16
#: Lines of a slice; its filter takes BITS_PER_LINE bits for each, 16 MB in all.
SLICE_LINES = 8_000_000
#: Lines whose bits a task folds before it sends them, and filters that it holds at once.
FOLDED, HELD = 1 << 20, 4


def line_key(line: bytes) -> bytes:
    return line.lower().strip(SPACE)  # of bytes, lower() turns A-Z only


def long_enough(key: bytes) -> bool:
    return len(key) >= 4 * MIN_CHARS or len(key) >= MIN_CHARS and len(key.decode("utf-8", "replace")) >= MIN_CHARS


def digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _pairs(slices: int):
    def run(batch: pa.RecordBatch):
        rows, found = [], []
        for n, body in enumerate(batch.column(2).to_pylist()):
            own = {digest(k) for x in body.lower().split(b"\n") if len(x) >= MIN_CHARS and long_enough(k := x.strip(SPACE))}
            rows += [n] * len(own)
            found += own
        where = np.frombuffer(b"".join(found), dtype="<u4").reshape(-1, 4)[:, 3] % slices if found else np.zeros(0)
        rows = pa.array(rows, pa.int32())
        yield {"line": found, "id": batch.column(0).take(rows), "mark": batch.column(1).take(rows), "slice": where.astype(np.int32)}
    return run


def _bits(lines: pa.Array, size: int) -> np.ndarray:
    """The filter positions of each line: one row per line, two columns."""
    words = np.frombuffer(b"".join(lines.to_pylist()), dtype="<u4").reshape(-1, 4)
    bits = words[:, :2].astype(np.int64) * size >> 32
    bits[:, 1] += bits[:, 1] == bits[:, 0]  # a line alone sets no bit twice
    bits[:, 1] %= size
    return bits


def _marks(size: int):
    """Per filter slice and chunk: the bits that a task's lines set, and whether each was set again."""
    def fold(held):
        at, times = np.unique(np.concatenate(held), return_counts=True)
        cuts = np.flatnonzero(np.diff(at // CHUNK)) + 1
        parts, again = np.split((at % CHUNK).astype("<u2"), cuts), np.split(times > 1, cuts)
        first = at[np.r_[0, cuts]]
        return pa.RecordBatch.from_pydict({
            "slice": pa.array(first // size, pa.int32()), "chunk": pa.array(first % size // CHUNK, pa.int32()),
            "bits": pa.array([x.tobytes() for x in parts], pa.binary()), "again": pa.array([np.packbits(x).tobytes() for x in again], pa.binary())})

    def run(batches):
        held, lines = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append((_bits(batch.column(0), size) + batch.column(1).to_numpy()[:, None].astype(np.int64) * size).ravel())
                lines += batch.num_rows
            if lines >= FOLDED:
                yield fold(held)
                held, lines = [], 0
        if held:
            yield fold(held)
    return run


def _merge(key, group):
    """The two filters of a chunk, folded over the tasks; the once-seen one is needed no longer afterwards."""
    once, twice = np.zeros(CHUNK, bool), np.zeros(CHUNK, bool)
    for bits, again in zip(group.column("bits").to_pylist(), group.column("again").to_pylist()):
        at = np.frombuffer(bits, "<u2")
        twice[at] |= once[at] | np.unpackbits(np.frombuffer(again, np.uint8))[: len(at)].astype(bool)
        once[at] = True
    return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "chunk": pa.array([key[1].as_py()], pa.int32()),
                     "twice": pa.array([np.packbits(twice).tobytes()], pa.binary())})


def _read_filter(folder: str, size: int):
    """Reads the twice-seen filter of a slice from the shared folder."""
    def read(number: int) -> np.ndarray:
        system, path = fs.FileSystem.from_uri(folder) if ":" in folder.split("/")[0] else (fs.LocalFileSystem(), folder)
        twice = np.zeros(size // 8, np.uint8)
        for chunk, bits in zip(*pq.read_table(f"{path}/slice={number}", filesystem=system, columns=["chunk", "twice"]).to_pydict().values()):
            twice[chunk * CHUNK // 8 : (chunk + 1) * CHUNK // 8] = np.frombuffer(bits, np.uint8)
        return twice
    return read


def _suspects(read, size: int):
    def run(batches):
        held = lru_cache(HELD)(read)
        for batch in batches:
            slices = batch.column(1).to_numpy()
            for number in np.unique(slices).tolist():
                own = batch.filter(pa.array(slices == number))
                twice, bits = held(number), _bits(own.column(0), size)
                hit = ((twice[bits >> 3] >> (7 - (bits & 7))) & 1).all(axis=1)
                yield own.filter(pa.array(hit)).select(["line", "id", "mark"])
    return run


def suspected_lines(docs: DataFrame, slice_lines: int = SLICE_LINES) -> DataFrame:
    """(line digest, id, mark) of each line that the twice-seen filter holds. ``docs`` has ``id`` and ``body``; ``mark``
    is a hash of the body."""
    text = F.col("body").cast("string")
    ends = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    lines = docs.agg(F.sum(ends)).first()[0] or 0
    slices = max(1, math.ceil(lines / slice_lines))
    size = max(CHUNK, math.ceil(math.ceil(lines / slices) * BITS_PER_LINE / CHUNK) * CHUNK)
    rows = docs.select("id", F.xxhash64("body").alias("mark"), "body")
    pairs = stored(map_arrow(rows, _pairs(slices), "line binary, id long, mark long, slice int"), "lines", "slice")
    marks = pairs.select("line", "slice").mapInArrow(_marks(size), "slice int, chunk int, bits binary, again binary")
    merged = marks.groupBy("slice", "chunk").applyInArrow(_merge, "slice int, chunk int, twice binary")
    folder = shared_folder(docs.sparkSession, "filters")
    merged.write.partitionBy("slice").parquet(folder)
    found = pairs.select("line", "slice", "id", "mark").mapInArrow(_suspects(_read_filter(folder, size), size), "line binary, id long, mark long")
    return stored(found, "suspects")


def lines_to_drop(docs: DataFrame, slice_lines: int = SLICE_LINES) -> DataFrame:
    """``id``, ``mark`` and the digests of the lines that rows with this id and text lose, ``lost``. A line goes from all
    rows of an id or from none, so texts whose marks meet by chance lose no other lines."""
    suspects = suspected_lines(docs, slice_lines)
    repeats = suspects.groupBy("line").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("rows"))
    repeats = stored(repeats.filter("first < last").drop("last"), "repeats")
    total = suspects.count()
    lost = lookup(suspects, repeats, "line", "rows", total).filter("id > first")
    return lost.groupBy("id", "mark").agg(F.collect_set("line").alias("lost"))


def _keep(batch: pa.RecordBatch):
    """Of id, body, lost: the lines that stay, and how many there were and went."""
    names = batch.schema.names
    bodies, lost = batch.column(names.index("body")).to_pylist(), batch.column(names.index("lost")).to_pylist()
    texts, count, dropped = [], [], []
    for body, gone in zip(bodies, lost):
        lines = body.split(b"\n")
        if gone:
            gone = set(gone)
            kept = [x for x in lines if len(x) < MIN_CHARS or not (long_enough(k := line_key(x)) and digest(k) in gone)]
            texts.append(b"\n".join(kept))
        else:
            kept = lines
            texts.append(body)
        count.append(len(lines))
        dropped.append(len(lines) - len(kept))
    yield texts, count, dropped


def kept_lines(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, ``kept_text``, ``n_lines``, ``n_dropped``, and the SHA-256 of the kept text."""
    docs = id_and_text(df, key, text)
    joined = docs.withColumn("mark", F.xxhash64("body")).join(lines_to_drop(docs), ["id", "mark"], "left").select("id", "body", "lost")

    def run(batch):
        for texts, count, dropped in _keep(batch):
            yield {"id": batch.column(0), "kept_text": [x.decode("utf-8", "replace") for x in texts], "n_lines": count,
                   "n_dropped": dropped, "kept_sha256": [hashlib.sha256(x).hexdigest() for x in texts]}

    out = map_arrow(joined, run, "id long, kept_text string, n_lines long, n_dropped long, kept_sha256 string")
    return out.withColumn("id", original_id()).withColumnRenamed("id", key)


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` with repeated lines taken out of ``text``; all other columns as they are."""
    number, mark, gone = unused(df, "id", "mark", "lost")
    lost = lines_to_drop(id_and_text(df, key, text)).select(F.col("id").alias(number), F.col("mark").alias(mark), F.col("lost").alias(gone))
    own = [F.col(f"`{c}`") for c in df.columns]
    named = df.withColumn(number, F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NO_ID)))
    named = named.withColumn(mark, F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")))
    joined = named.join(lost, [number, mark], "left")
    schema, at = df.schema, df.columns.index(text)

    def over(batches):
        for batch in batches:
            bodies = batch.column(at).cast(pa.binary()).to_pylist()
            columns = {"body": pa.array([b or b"" for b in bodies], pa.binary()), "lost": batch.column(len(schema))}
            texts = next(_keep(pa.RecordBatch.from_pydict(columns)))[0]
            new = pa.array([None if b is None else x.decode("utf-8", "replace") for b, x in zip(bodies, texts)], batch.column(at).type)
            yield pa.RecordBatch.from_arrays([new if i == at else batch.column(i) for i in range(len(schema))], names=schema.names)

    return joined.select(*own, gone).mapInArrow(over, schema)
