"""Ranked lexical search: the best documents for each query by summed term impacts.

Method: documents are dealt to shards of bounded size, and each shard stores, for every term of the queries, its
documents and counts, one row a shard. Once the whole table's counts are known, a shard turns counts into impacts, sorts
each list by them, and answers every query by NRA: it reads the query's lists block by block from the highest impact
down, never looks a document up, and keeps for each document the lower bound of its score (what was read) and the upper
one (what was read plus the next impact of every list in which it was not met). It stops once no unseen document can
reach the k-th best lower bound and every document that can has equal bounds, so that membership, ties and final scores
are settled. A task carries its k-th best score from shard to shard as a floor. At most k rows a task and query move.

A term that every document holds makes a long list in every shard, not one huge list. Queries reach the tasks in
slices of a bounded number of words; each slice has its own index and its own pass.

Defined results: null and empty texts have no terms and are no documents for the counts; each row is a document, also if
it repeats an id; null ids come after all others among equal scores and stay null; query rows that repeat both id and
text count once; a query without terms has no rows; other columns are not carried.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import id_and_text, original_id, stored
from riskloom.llm.decontaminate import item_slices, words

TOP = 20
SHARD_WORDS = 2_000_000
#: Postings of each list that the first step of a query reads; every step reads twice as many.
FIRST_BLOCK = 64

_INDEX = pa.schema([("n_docs", pa.int64()), ("n_words", pa.int64()), ("ids", pa.binary()), ("lengths", pa.binary()),
                    ("terms", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int64())), ("docs", pa.binary()), ("counts", pa.binary())])


def _shard(ids: list[int], lengths: list[int], found: list[np.ndarray]) -> dict:
    """One index row. Documents of the shard are numbered in the order of their ids, postings in that of their terms."""
    order = np.argsort(np.array(ids, np.int64), kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    terms = np.concatenate(found)
    keys, counts = np.unique(terms * len(ids) + np.repeat(place, [len(x) for x in found]), return_counts=True)
    own, sizes = np.unique(keys // len(ids), return_counts=True)
    lengths = np.array(lengths, np.int64)[order]
    return {"n_docs": int((lengths > 0).sum()), "n_words": int(lengths.sum()), "ids": np.array(ids, "<i8")[order].tobytes(),
            "lengths": lengths.tobytes(), "terms": own.tolist(), "sizes": sizes.tolist(),
            "docs": (keys % len(ids)).astype("<u4").tobytes(), "counts": counts.astype("<u4").tobytes()}


def _indexed(vocabulary, shard_words: int):
    def over(batches):
        known, ids, lengths, found, held = vocabulary.value, [], [], [], 0
        for batch in batches:
            for i, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = words(body)
                own = np.fromiter((known[w] for w in text if w in known), np.int64)
                ids.append(i), lengths.append(len(text)), found.append(own)
                held += len(text) + 1
                if held >= shard_words:
                    yield pa.RecordBatch.from_pylist([_shard(ids, lengths, found)], _INDEX)
                    ids, lengths, found, held = [], [], [], 0
        if ids:
            yield pa.RecordBatch.from_pylist([_shard(ids, lengths, found)], _INDEX)
    return over


def build_index(docs: DataFrame, vocabulary: dict[bytes, int], shard_words: int = SHARD_WORDS) -> DataFrame:
    """Store one row per shard of ``docs`` (id, body): its documents, and the postings of the terms in ``vocabulary``."""
    terms = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return stored(docs.mapInArrow(_indexed(terms, shard_words), "n_docs long, n_words long, ids binary, lengths binary, "
                                  "terms array<int>, sizes array<long>, docs binary, counts binary"), "ranked-index")


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(counts: np.ndarray, lengths: np.ndarray, documents: int, all_words: int) -> np.ndarray:
    measure = 100 - 25 + (25 * lengths * documents) // all_words
    return (1_000_000_000 * counts) // (1000 * counts + 12 * measure)


def best(lists: list[tuple[np.ndarray, np.ndarray]], size: int, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """NRA over ``lists`` of (documents, values), values falling: the ``k`` best documents by (value sum, then number),
    and their sums; documents below ``floor`` may be left out. ``size`` is the number of documents."""
    lower = np.zeros(size, np.int64)
    unmet = np.ones((size, len(lists)), bool)
    head = np.array([v[0] if len(v) else 0 for _, v in lists], np.int64)
    at, step = 0, FIRST_BLOCK
    while True:
        for j, (docs, values) in enumerate(lists):
            own = docs[at : at + step]
            lower[own] += values[at : at + step]
            unmet[own, j] = False
            head[j] = values[at + step] if at + step < len(values) else 0
        at, step = at + step, 2 * step
        reached = np.flatnonzero(lower)
        least = max(floor, 1)
        if len(reached) >= k:
            least = max(least, int(np.partition(lower[reached], len(reached) - k)[len(reached) - k]))
        unseen = int(head.sum())
        if unseen >= least:
            continue
        near = reached[lower[reached] + unseen >= least]
        upper = lower[near] + unmet[near] @ head
        if (upper[upper >= least] == lower[near][upper >= least]).all():
            near = near[lower[near] >= least]
            near = near[np.argsort(-lower[near], kind="stable")][:k]
            return near, lower[near]


def _answers(queries, weights: np.ndarray, documents: int, all_words: int, k: int):
    schema = pa.schema([("query", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])

    def over(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries.value)
        for batch in batches:
            for row in range(batch.num_rows):
                answer(batch.slice(row, 1), held)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.arange(len(held)), [len(i) for i, _ in held]), pa.int32()),
            pa.array(np.concatenate([i for i, _ in held]) if held else [], pa.int64()),
            pa.array(np.concatenate([s for _, s in held]) if held else [], pa.int64())], schema=schema)

    def answer(shard, held):
        ids, lengths, docs, counts = (np.frombuffer(shard.column(n)[0].as_py(), t) for n, t in (
            ("ids", "<i8"), ("lengths", "<i8"), ("docs", "<u4"), ("counts", "<u4")))
        terms, sizes = (np.array(shard.column(n)[0].as_py(), np.int64) for n in ("terms", "sizes"))
        values = impacts(counts.astype(np.int64), lengths[docs], documents, all_words)
        order = np.lexsort((docs, -values, np.repeat(np.arange(len(terms)), sizes)))
        cuts = np.cumsum(sizes)[:-1]
        lists = dict(zip(terms.tolist(), zip(np.split(docs[order], cuts), np.split(values[order], cuts))))
        for q, wanted in enumerate(queries.value):
            own = [(lists[t][0], lists[t][1] * (n * int(weights[t]))) for t, n in wanted if t in lists and weights[t]]
            if not own:
                continue
            floor = int(held[q][1][-1]) if len(held[q][0]) == k else 0
            near, score = best(own, len(ids), k, floor)
            both = np.r_[held[q][0], ids[near]], np.r_[held[q][1], score]
            keep = np.lexsort((both[0], -both[1]))[:k]
            held[q] = both[0][keep], both[1][keep]
    return over


def search(df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
           item_text: str = "text", k: int = TOP, shard_words: int = SHARD_WORDS, slice_words: int | None = None) -> DataFrame:
    """Per row of ``items`` its ``k`` best documents with a score above 0: ``item``, ``rank``, ``key``, ``score``."""
    spark, docs = df.sparkSession, id_and_text(df, key, text)
    slices = item_slices(items, item, item_text, slice_words) if slice_words else item_slices(items, item, item_text)
    next(slices)
    kind = items.schema[item].dataType
    found = spark.createDataFrame([], "item string, query int, slice int, id long, score long")
    for number, own in enumerate(slices):
        vocabulary = {w: n for n, w in enumerate(dict.fromkeys(w for _, text_ in own for w in text_))}
        if not vocabulary:
            continue
        index = build_index(docs, vocabulary, shard_words)
        documents, all_words = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
        pairs = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("p")).groupBy("p.terms").agg(F.sum("p.sizes").alias("n"))
        weights = np.zeros(len(vocabulary), np.int64)
        for row in pairs.collect():  # as many as the slice has terms
            weights[row["terms"]] = term_weight(documents, row["n"])
        asked = []
        for _, text_ in own:
            codes, times = np.unique([vocabulary[w] for w in text_], return_counts=True)
            asked.append(list(zip(codes.tolist(), times.tolist())))
        answers = index.mapInArrow(_answers(spark.sparkContext.broadcast(asked), weights, documents, all_words, k),
                                   "query int, id long, score long")
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(own)], "query int, item string")
        found = found.unionByName(answers.join(F.broadcast(names), "query").withColumn("slice", F.lit(number)))
    by = [F.col("score").desc(), F.col("id").asc()]
    part = F.pmod(F.xxhash64("id"), F.lit(16))  # halves on the way: no task gets all that the tasks found for a query
    first = found.withColumn("place", F.row_number().over(W.partitionBy("slice", "query", part).orderBy(*by))).filter(F.col("place") <= k)
    rank = F.row_number().over(W.partitionBy("slice", "query").orderBy(*by))
    return first.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        F.col("item").cast(kind).alias(item), "rank", original_id().alias(key), "score")
