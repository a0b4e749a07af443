"""SimHash near-dedup: fingerprints of word shingles, linked at a small Hamming distance.

Method: an inverted index from positional bytes to fingerprints with count filtering. Two 64-bit fingerprints that
differ in at most two bits share at least six of their eight bytes in place, so of the four two-byte blocks at least
two are whole. The index therefore has a list for each pair of blocks and their four bytes, six lists a fingerprint.
Fingerprints of a list tally the positional bytes they share; pairs with six or more are kept and verified by
counting bits. Equal fingerprints are one entry. Lists of many fingerprints are cut into blocks that meet in pairs of
blocks, and a task returns a spanning forest of the links it found rather than all of them.

Defined results: null or empty text has fingerprint zero and is linked like any other; fewer words than a shingle are
one shingle; a null id counts as one that comes after all others; rows that repeat an id keep a row each.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import (NO_ID, cells, connected_components, group_bounds, id_and_text, lookup, map_arrow,
                                 original_id, runs, stored, text_mark, unused)

WORDS, SEED, BITS = 3, 42, 2
BLOCK = 4096  # fingerprints of a list that a task compares at once with as many others
PIECE = 1 << 16  # shingles counted at once


def fingerprint(body: bytes) -> int:
    """Unsigned; a bit is set if more than half of the shingle hashes have it."""
    words = body.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    text = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, n: a + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    hashed = xxhash.xxh64_digest
    tops = ends[WORDS - 1 :] or ends[-1:]
    ones = np.zeros(64, np.int64)
    for k in range(0, len(tops), PIECE):
        found = b"".join([hashed(text[a:b], SEED) for a, b in zip(starts[k : k + PIECE], tops[k : k + PIECE])])
        ones += np.unpackbits(np.frombuffer(found, np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > len(tops)).tobytes(), "big")


def _prints(batch: pa.RecordBatch):
    made = np.array([fingerprint(b) for b in batch.column(1).to_pylist()], np.uint64)
    yield {"id": batch.column(0), "print": made.view(np.int64), "mark": batch.column(2)}


def fingerprints(docs: DataFrame) -> DataFrame:
    """(id, print, mark) per row of (id, body); ``mark`` tells rows apart that share an id."""
    return map_arrow(docs.withColumn("mark", text_mark(F.col("body"))), _prints, "id long, print long, mark binary")


def _forest(prints: np.ndarray, bits: int) -> tuple[list, list]:
    """Links (smaller print first in its tree) that connect all fingerprints within ``bits`` of each other."""
    a, b = [], []
    left = np.ones(len(prints), bool)
    low = np.uint64(0x0101010101010101)
    for root in range(len(prints)):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue:
            at = np.flatnonzero(left)
            if not len(at):
                return a, b
            one = queue.pop()
            apart = prints[at] ^ prints[one]
            folded = apart | apart >> np.uint64(4)
            folded |= folded >> np.uint64(2)
            folded |= folded >> np.uint64(1)
            shared = 8 - np.bitwise_count(folded & low)  # positional bytes in common
            near = np.flatnonzero(shared >= 8 - bits)
            near = at[near[np.bitwise_count(apart[near]) <= bits]]
            left[near] = False
            queue.extend(near.tolist())
            a += prints[near].view(np.int64).tolist()
            b += [int(prints[one : one + 1].view(np.int64)[0])] * len(near)
    return a, b


def _links(bits: int):
    def run(group: pa.Table):
        keys, prints = group.column("cell").to_numpy(), group.column("print").to_numpy().view(np.uint64)
        bounds = group_bounds(keys)
        a, b = [], []
        for i, j in zip(bounds[:-1], bounds[1:]):
            if j - i == 2:
                if int(prints[i] ^ prints[i + 1]).bit_count() <= bits:
                    a.append(int(prints[i : i + 1].view(np.int64)[0]))
                    b.append(int(prints[i + 1 : i + 2].view(np.int64)[0]))
            else:
                more = _forest(prints[i:j], bits)
                a += more[0]
                b += more[1]
        yield {"a": a, "b": b}
    return run


def block_lists(prints: DataFrame) -> DataFrame:
    """(list, print): the six lists of each fingerprint."""
    part = [F.shiftrightunsigned("print", 48 - 16 * i).bitwiseAND(0xFFFF) for i in range(4)]
    keys = [F.lit(n << 32) + F.shiftleft(part[i], 16) + part[j] for n, (i, j) in enumerate(combinations(range(4), 2))]
    return prints.select("print", F.explode(F.array(*keys)).alias("list"))


def components(prints: DataFrame, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """Adds ``component``, the smallest id within reach, to stored rows of (id, print, ..)."""
    if not 0 <= bits <= 2:
        raise ValueError("the six lists find fingerprints that differ in at most two bits")
    classes = stored(prints.groupBy("print").agg(F.count("*").alias("rows"), F.min("id").alias("first")), "classes")
    celled = cells(block_lists(classes.select("print")), "list", "print", block)
    links = runs(celled.select("cell", "print"), "cell", _links(bits), "a long, b long")
    nodes = stored(connected_components(links), "nodes")
    joined = classes.join(nodes.withColumnRenamed("node", "print"), "print", "left")
    joined = stored(joined.withColumn("component", F.coalesce("component", "print")), "joined")
    least = stored(joined.groupBy("component").agg(F.min("first").alias("least"), F.count("*").alias("many")), "least")
    total = joined.count()
    answer = lookup(joined, least, "component", "many", total).select("print", "rows", F.col("least").alias("component"))
    answer = stored(answer, "answer")
    return lookup(prints, answer, "print", "rows", prints.count()).drop("rows")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """Per row: the id, its fingerprint in hex, and the smallest id of its component."""
    prints = stored(fingerprints(id_and_text(df, key, text)), "prints")
    out = components(prints, bits)
    return out.select(original_id().alias(key), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
                      original_id("component").alias("component_id"))


def drop_near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """The row of the smallest id of each component, all columns as they are. Rows of that id with equal texts are one row."""
    prints = stored(fingerprints(id_and_text(df, key, text)), "prints")
    own, mark = unused(df, "id", "mark")
    kept = components(prints, bits).filter("id = component").select(F.col("id").alias(own), F.col("mark").alias(mark)).distinct()
    marked = df.withColumn(own, F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NO_ID)))
    marked = marked.withColumn(mark, text_mark(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")))
    return marked.join(kept, [own, mark], "left_semi").dropDuplicates([own, mark]).select(*[F.col(f"`{c}`") for c in df.columns])
