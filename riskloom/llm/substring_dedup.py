"""Substring dedup: words of passages that a document with a smaller id holds go.

Method: every window of WINDOW words gets a Rabin-Karp hash. Blocks of documents count their own windows first: what a
block's smallest document holds too is lost there and then, and one entry for each document that may still be first
goes to the bucket of its hash, eight bytes each, packed by block. A bucket finds the smallest document of every hash
and sends the places of all other entries back to their blocks, which merge them into maximal removal intervals. Texts
move once, compressed, to meet their intervals. The bucket comes from a second hash, so that bits are compared beside
the 64 that are sent; their number grows with the table, as buckets hold about BUCKET_WINDOWS windows.

A window that many documents hold is one entry a block, however often it occurs there: no key gathers more entries than
there are blocks times its repeats within one document. ``df`` is read twice and must give the same rows, as files do.

Defined results: null and empty texts have no words and nothing is removed; null ids act as one document after all
others; rows that repeat an id are one document, each row filtered alike; other columns are not carried.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import group_bounds, id_and_text, map_arrow, original_id, runs, stored
from riskloom.llm.rolling import BASES, arrays, by_bucket, each, from_planes, planes, rolling, word_values

WINDOW = 13
#: Words of a block; a longer document is a block of its own.
BLOCK_WORDS = 1_000_000
#: About as many windows meet in a bucket, by WORD_BYTES a word.
BUCKET_WINDOWS, WORD_BYTES = 1_000_000, 6

_SENT = pa.schema([("key", pa.int64()), ("block", pa.int64()), ("hashes", pa.binary()), ("places", pa.binary()),
                   ("ids", pa.binary()), ("counts", pa.binary()), ("marks", pa.binary())])
_SENT_TYPES = "key long, block long, hashes binary, places binary, ids binary, counts binary, marks binary"
_BACK_TYPES = "block long, places binary, ids binary, counts binary, marks binary"


def _block_rows(block: int, docs: list[tuple[int, bytes]], texts: list[list[bytes]], window: int, buckets: int):
    """What a block sends: its description, and for each bucket the windows that may be the first of their kind."""
    order = sorted(range(len(docs)), key=lambda k: docs[k][0])
    ids = np.array([docs[k][0] for k in order], np.int64)
    lengths = np.array([len(texts[k]) for k in order], np.int64)
    values = word_values([w for k in order for w in texts[k]])
    owner, ends = np.repeat(np.arange(len(ids)), lengths), np.repeat(np.cumsum(lengths), lengths)
    at = np.flatnonzero(np.arange(len(owner)) + window <= ends)
    one, two = (rolling(v, window, b)[at] for v, b in zip(values, BASES))
    by = np.argsort(one, kind="stable")
    fresh = np.r_[True, (one[by][1:] != one[by][:-1]) | (two[by][1:] != two[by][:-1])][: len(by)]
    holder = ids[owner[at[by]]]
    first = holder[fresh][np.cumsum(fresh) - 1]
    open_ = np.sort(by[holder == first])
    yield {"key": -1 - block, "block": block, "places": planes(np.sort(at[by[holder != first]])),
           "ids": ids.tobytes(), "counts": lengths.tobytes(), "marks": b"".join(docs[k][1] for k in order)}
    for bucket, own in by_bucket((two[open_] % np.uint64(buckets)).astype(np.int64), buckets):
        own = open_[own]
        docs_of, counts = np.unique(owner[at[own]], return_counts=True)
        yield {"key": bucket, "block": block, "hashes": one[own].tobytes(), "places": planes(at[own]),
               "ids": ids[docs_of].tobytes(), "counts": counts.astype(np.int64).tobytes()}


def _windows(window: int, buckets: int, block_words: int):
    def over(batches):
        block, docs, texts, held = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for i, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = body.split()
                docs.append((i, xxhash.xxh3_128_digest(body))), texts.append(words)
                held += len(words)
                if held >= block_words:
                    yield from made(block, docs, texts)
                    block, docs, texts, held = block + 1, [], [], 0
        if docs:
            yield from made(block, docs, texts)

    def made(block, docs, texts):
        rows, size = [], 0
        for row in _block_rows(block, docs, texts, window, buckets):
            rows.append(row)
            size += sum(len(v) for v in row.values() if isinstance(v, bytes))
            if size > 1 << 24:
                yield pa.RecordBatch.from_pylist(rows, _SENT)
                rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, _SENT)
    return over


def _meet(group: pa.Table):
    """In a bucket: all entries but those of the smallest document that has the window. Descriptions pass."""
    if group.column("key")[0].as_py() < 0:
        yield {n: group.column(n).combine_chunks() for n in ("block", "places", "ids", "counts", "marks")}
        return
    hashes, places = arrays(group, "hashes", "<u8"), [from_planes(p) for p in group.column("places").to_pylist()]
    ids = np.concatenate([np.repeat(i, c) for i, c in zip(arrays(group, "ids", "<i8"), arrays(group, "counts", "<i8"))])
    every = np.concatenate(hashes)
    order = np.argsort(every, kind="stable")
    bounds = group_bounds(every[order])
    least = np.empty_like(ids)
    least[order] = np.repeat(np.minimum.reduceat(ids[order], bounds[:-1]), np.diff(bounds))
    lost = np.split(ids > least, np.cumsum([len(h) for h in hashes])[:-1])
    found = [(b, planes(p[x])) for b, p, x in zip(group.column("block").to_pylist(), places, lost) if x.any()]
    if found:
        nothing = [None] * len(found)
        yield {"block": [b for b, _ in found], "places": [p for _, p in found], "ids": nothing, "counts": nothing, "marks": nothing}


def intervals(starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches (first word, word after the last) that sorted windows cover."""
    fresh = np.flatnonzero(np.r_[True, starts[1:] > starts[:-1] + window][: len(starts)])
    return starts[fresh], starts[np.r_[fresh[1:] - 1, len(starts) - 1][: len(fresh)]] + window


def _merge(window: int):
    def run(group: pa.Table):
        marks = group.column("marks").to_pylist()
        own = next(k for k, m in enumerate(marks) if m is not None)
        ids, lengths = (arrays(group.slice(own, 1), n, "<i8")[0] for n in ("ids", "counts"))
        places = np.sort(np.concatenate([from_planes(p) for p in group.column("places").to_pylist()]))
        offsets = np.cumsum(np.r_[0, lengths])
        cuts = np.searchsorted(places, offsets)
        out = {"id": [], "mark": [], "starts": [], "ends": []}
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            start, end = intervals(places[cuts[k] : cuts[k + 1]] - offsets[k], window)
            for name, value in zip(out, (int(ids[k]), marks[own][16 * k : 16 * k + 16], start.tolist(), end.tolist())):
                out[name].append(value)
        yield out
    return run


def removals(docs: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """Of ``docs`` (id, body): ``id`` and ``mark`` (128-bit digest of the body) of each text that loses words, with the
    removal intervals ``starts`` and ``ends`` in words."""
    size = docs.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    buckets = max(1, math.ceil(size / WORD_BYTES / bucket_windows))
    sent = docs.mapInArrow(_windows(window, buckets, block_words), _SENT_TYPES)
    back = runs(sent, "key", each("key", _meet), _BACK_TYPES)
    found = runs(back, "block", each("block", _merge(window)), "id long, mark binary, starts array<long>, ends array<long>")
    return stored(found, "removals").dropDuplicates(["id", "mark"])


def _packed(batch: pa.RecordBatch):
    bodies = batch.column(1).to_pylist()
    small = zstandard.ZstdCompressor(level=1)
    yield {"id": batch.column(0), "mark": [xxhash.xxh3_128_digest(b) for b in bodies], "packed": [small.compress(b) for b in bodies]}


def _keep(batch: pa.RecordBatch):
    ids, _, bodies, starts, ends = (batch.column(k) for k in range(5))
    whole, out = zstandard.ZstdDecompressor(), {"n_words": [], "n_removed": [], "kept": [], "kept_sha256": [], "starts": starts, "ends": ends}
    for body, start, end in zip(bodies.to_pylist(), starts.to_pylist(), ends.to_pylist()):
        words = whole.decompress(body).split()
        start, end = start or [], end or []
        kept = b" ".join([w for a, b in zip([0, *end], [*start, len(words)]) for w in words[a:b]])
        out["n_words"].append(len(words))
        out["n_removed"].append(sum(end) - sum(start))
        out["kept"].append(kept.decode("utf-8", "replace"))
        out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
    yield {"id": ids, **out}


def dedup_substrings(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                     block_words: int = BLOCK_WORDS, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """Per row: the id, ``n_words``, ``n_removed``, the ``kept`` words and their SHA-256, and the removal intervals
    ``starts`` and ``ends`` (null if none)."""
    docs = id_and_text(df, key, text)
    gone = removals(docs, window, block_words, bucket_windows)
    joined = map_arrow(docs, _packed, "id long, mark binary, packed binary").join(gone, ["id", "mark"], "left")
    out = map_arrow(joined, _keep, "id long, n_words long, n_removed long, kept string, kept_sha256 string, "
                                   "starts array<long>, ends array<long>")
    return out.withColumn("id", original_id()).withColumnRenamed("id", key)
