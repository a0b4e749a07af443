"""Embedding near-dedup: random-hyperplane sign hashing in several tables, exact cosines, connected components.

Method: each table hashes a vector to the signs of its products with random hyperplanes. Vectors that share a bucket in
any table are compared exactly, in double precision; a pair is counted in the first table in which it meets, so links
are counted once. The number of hyperplanes follows the number of vectors, so that buckets stay small, and the number
of tables follows from the recall wanted at the threshold. Equal vectors are compared as one. Buckets of many vectors
are cut into blocks that meet in pairs. A task returns link counts and a spanning forest, never all its pairs.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with nothing; vectors
of different lengths link with nothing of another length; a null id counts as one after all others; rows that repeat
an id are vectors of their own, which count as links of one another when alike.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import NO_ID, cells, connected_components, group_bounds, lookup, map_arrow, original_id, runs, stored

THRESHOLD, RECALL, SEED = 0.95, 0.998, 20240229
BUCKET = 32  # vectors a bucket should hold if directions were spread evenly
BLOCK = 1024


def plan(vectors: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(hyperplanes of a table, tables): a pair at the threshold shares a table's bucket with probability p^planes."""
    planes = max(4, math.ceil(math.log2(max(vectors, 1) / BUCKET))) if vectors > 16 * BUCKET else 4
    same = (1 - math.acos(threshold) / math.pi) ** planes
    return planes, max(1, math.ceil(math.log(1 - recall) / math.log1p(-same)))


def hyperplanes(dimensions: int, planes: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dimensions]).standard_normal((dimensions, tables * planes))


def _clean(batch: pa.RecordBatch):
    """Valid vectors as bytes of doubles; the mark tells which vectors are equal."""
    ids, raw = [], []
    for i, values in zip(batch.column(0).to_pylist(), batch.column(1)):
        x = values.values
        if x is None or not len(x) or x.null_count:
            continue
        x = x.to_numpy(zero_copy_only=False).astype(np.float64)
        if np.isfinite(x).all() and x.any():
            ids.append(i)
            raw.append(x.astype("<f8").tobytes())
    yield {"id": ids, "vector": raw}


def _sign(planes: int, tables: int):
    def run(batch: pa.RecordBatch):
        held = batch.column(1).to_pylist()
        out = [None] * len(held)
        weights = 1 << np.arange(planes, dtype=np.int64)
        for size in {len(v) for v in held}:
            at = [k for k, v in enumerate(held) if len(v) == size]
            x = np.frombuffer(b"".join(held[k] for k in at), "<f8").reshape(len(at), -1)
            x = x / np.abs(x).max(axis=1, keepdims=True)
            signs = (x @ hyperplanes(x.shape[1], planes, tables) > 0).reshape(len(at), tables, planes)
            for k, own in zip(at, (signs @ weights).tolist()):
                out[k] = own
        yield {"one": batch.column(0), "vector": held, "rows": batch.column(2), "buckets": out}
    return run


def _unit(held: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(held), "<f8").reshape(len(held), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _compare(threshold: float):
    """Of each cell: the link counts of its vectors and a forest of its links."""
    def run(group: pa.Table):
        names = ("cell", "table", "one", "side", "left", "right", "rows")
        cell, table, one, side, left, right, rows = (group.column(c).to_numpy() for c in names)
        vectors, buckets = group.column("vector").to_pylist(), group.column("buckets").to_pylist()
        bounds = group_bounds(cell)
        found, links, a, b = [], [], [], []
        for i, j in zip(bounds[:-1], bounds[1:]):
            sizes = {len(v) for v in vectors[i:j]}
            for size in sizes:
                own = np.array([k for k in range(i, j) if len(vectors[k]) == size])
                if len(own) < 2:
                    continue
                x = _unit([vectors[k] for k in own])
                met = np.array([buckets[k] for k in own])
                t, across = int(table[i]), left[i] != right[i]
                parent = np.arange(len(own))
                count = np.zeros(len(own), np.int64)
                for s in range(0, len(own), 256):
                    alike = x[s : s + 256] @ x.T >= threshold
                    alike &= np.arange(len(own)) > np.arange(s, min(s + 256, len(own)))[:, None]
                    if across:
                        alike &= side[own] != side[own[s : s + 256]][:, None]
                    p, q = np.nonzero(alike)
                    p += s
                    if t:
                        new = ~(met[p][:, :t] == met[q][:, :t]).any(axis=1)
                        p, q = p[new], q[new]
                    np.add.at(count, p, rows[own[q]])
                    np.add.at(count, q, rows[own[p]])
                    _join(parent, p, q)
                at = np.flatnonzero(count)
                found += one[own[at]].tolist()
                links += count[at].tolist()
                tied = np.flatnonzero(parent != np.arange(len(own)))
                a += one[own[tied]].tolist()
                b += one[own[parent[tied]]].tolist()
        yield {"a": found + a, "b": [None] * len(found) + b, "links": links + [0] * len(a)}
    return run


def _join(parent: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
    """Merge the trees of each pair: hang higher roots under the lowest of their neighbours until none differ."""
    while len(p):
        while (parent[parent] != parent).any():
            parent[:] = parent[parent]
        x, y = parent[p], parent[q]
        differ = x != y
        p, q, x, y = p[differ], q[differ], x[differ], y[differ]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
    while (parent[parent] != parent).any():
        parent[:] = parent[parent]


def links(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, recall: float = RECALL,
          block: int = BLOCK) -> DataFrame:
    """Per row: the id, ``n_links``, ``component_id``, ``kept``."""
    ids = df.select(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NO_ID)).alias("id"), F.col(f"`{vector}`").alias("vector"))
    valid = map_arrow(ids, _clean, "id long, vector binary")
    valid = stored(valid.withColumn("one", F.xxhash64("vector", F.sha1("vector"))), "vectors")
    # equal vectors are one entry, named by a 64-bit mark of their bytes
    classes = valid.groupBy("one").agg(F.count("*").alias("rows"), F.min("id").alias("least"), F.first("vector").alias("vector"))
    classes = stored(classes, "classes")
    many = classes.count()
    planes, tables = plan(many, threshold, recall)
    marked = stored(map_arrow(classes.select("one", "vector", "rows"), _sign(planes, tables), "one long, vector binary, rows long, buckets array<long>"), "signs")
    postings = marked.select("one", F.posexplode("buckets").alias("table", "bucket")).select(
        "one", "table", F.shiftleft(F.col("table").cast("long"), 48).bitwiseOR(F.col("bucket")).alias("list"))
    celled = cells(postings, "list", "one", block).drop("list").join(marked, "one")
    out = runs(celled, "cell", _compare(threshold), "a long, b long, links long")
    out = stored(out, "links")
    counts = out.filter("b IS NULL").groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "one")
    nodes = connected_components(out.filter("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "one")
    joined = classes.select("one", "rows", "least").join(counts, "one", "left").join(nodes, "one", "left")
    joined = stored(joined.withColumn("component", F.coalesce("component", "one")).withColumn("links", F.coalesce("links", F.lit(0))), "joined")
    roots = stored(joined.groupBy("component").agg(F.min("least").alias("root"), F.count("*").alias("many")), "roots")
    # a class of equal vectors links within itself
    answer = lookup(joined, roots, "component", "many", many).select("one", "rows", (F.col("links") + F.col("rows") - 1).alias("n_links"), "root")
    answer = stored(answer, "answer")
    linked = lookup(valid.select("id", "one"), answer, "one", "rows", valid.count()).select("id", "n_links", F.col("root").alias("component"))
    invalid = _invalid(ids).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    every = linked.unionByName(invalid)
    return every.select(original_id().alias(key), "n_links", original_id("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))


def _invalid(ids: DataFrame) -> DataFrame:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    held = F.col("vector").cast("array<double>")
    return ids.filter(held.isNull() | (F.size(held) == 0) | F.exists(held, bad) | F.forall(held, lambda x: x == 0)).select("id")
