"""What the operators of this package share: Arrow mapping, shared tables, heavy keys, connected components."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import shared_folder

#: Rows without an id share this one: they count as one document that comes after all others.
NO_ID = 2**63 - 1
#: At most so many keys are treated as heavy and broadcast; each of them holds over 1/HEAVY_KEYS of the rows.
HEAVY_KEYS = 1000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str, *partition: str) -> DataFrame:
    """Write to the folder all executors share and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.partitionBy(*partition).parquet(path) if partition else df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_and_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """``id`` long (NO_ID for null) and ``body`` binary (empty for null); other columns, whatever their names, go."""
    return df.select(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NO_ID)).alias("id"),
                     F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("body"))


def text_mark(body):
    """128 bits that tell texts apart."""
    return F.unhex(F.md5(body))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each behind as many underscores as make it differ from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while taken & {*names}:
        names = tuple(f"_{n}" for n in names)
    return list(names)


def original_id(c: str = "id"):
    return F.when(F.col(c) != NO_ID, F.col(c))


def map_arrow(df: DataFrame, run: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """Apply ``run`` to each Arrow batch; it yields dictionaries of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def over(batches):
        for batch in batches:
            for columns in run(batch):
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(over, schema)


def lookup(left: DataFrame, right: DataFrame, key: str, rows: str, total: int) -> DataFrame:
    """Inner join of ``left`` with ``right``, which is stored, has one row per key, and counts in ``rows`` how many
    rows of ``left`` the key has. Keys with more than total/HEAVY_KEYS rows, fewer than HEAVY_KEYS in number, are
    broadcast; for the others no partition gets more than that many rows of a key."""
    heavy = F.col(rows) > max(1, total // HEAVY_KEYS)
    hot = F.broadcast(right.filter(heavy))
    cold = right.filter(~heavy)
    return left.join(hot, key).unionByName(left.join(hot.select(key), key, "left_anti").join(cold, key))


def connected_components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """Nodes that have an edge, with the smallest node each can reach: ``node``, ``component``.

    ``edges`` has long columns ``a`` and ``b``. Large-star and small-star steps alternate until the edges are stars
    around each component's smallest node; the number of rounds grows with the logarithm of the longest path. Each
    round is written to the shared folder. A node's neighbours are never gathered: the least of them comes from a
    combining aggregation and returns by a join whose skewed side Spark splits.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                 purpose)
    seen = None
    for _ in itertools.count():
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark["n"] == 0 or (mark["n"], mark["h"]) == seen:
            break
        seen = mark["n"], mark["h"]
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, purpose)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(
            least.select("a", F.col("m").alias("b"))).distinct()
        now = stored(small, purpose)
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def runs(df: DataFrame, key: str, work: Callable[[pa.Table], Iterator[dict]], schema: str) -> DataFrame:
    """Apply ``work`` to the rows of each value of the long column ``key``, streaming over sorted partitions: many
    small groups cost little, and a task holds one group at a time. Groups must be of bounded size."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def over(batches):
        held: list[pa.RecordBatch] = []

        def done():
            whole = pa.Table.from_batches(held)
            for columns in work(whole):
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(batch.schema.names.index(key)).to_numpy()
            if keys[0] == keys[-1]:  # a group that may go on
                if held and held[-1].column(held[-1].schema.names.index(key))[-1].as_py() != keys[0]:
                    yield from done()
                    held.clear()
                held.append(batch)
                continue
            last = int(np.flatnonzero(keys != keys[-1])[-1]) + 1
            held.append(batch.slice(0, last))
            yield from done()
            held[:] = [batch.slice(last)]
        if held:
            yield from done()

    return df.repartition(F.col(key)).sortWithinPartitions(key).mapInArrow(over, schema)


def group_bounds(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts, and the end."""
    return np.r_[0, np.flatnonzero(np.diff(keys)) + 1, len(keys)] if len(keys) else np.zeros(1, int)


def cells(postings: DataFrame, key: str, member: str, block: int) -> DataFrame:
    """Adds ``cell`` (long), ``left`` and ``right``: rows that share ``key`` meet in cells of at most about two
    blocks of ``block`` rows. A key with more rows is cut into blocks by the hash of ``member``, and each pair of its
    blocks has a cell. Keys with one row go. ``side`` is the row's own block."""
    counts = postings.groupBy(key).agg(F.count("*").alias("rows")).filter("rows > 1")
    counts = stored(counts, "cells")
    total = counts.agg(F.sum("rows")).first()[0] or 0
    joined = lookup(postings, counts, key, "rows", total).withColumn("blocks", F.ceil(F.col("rows") / block).cast("int"))
    joined = joined.withColumn("side", F.pmod(F.xxhash64(F.lit(7), member), F.col("blocks")).cast("int"))
    joined = joined.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    left, right = F.least("side", "other"), F.greatest("side", "other")
    return joined.withColumn("left", left).withColumn("right", right).withColumn(
        "cell", F.when(F.col("blocks") == 1, F.col(key)).otherwise(F.xxhash64(key, "left", "right"))).drop("rows", "blocks", "other")
