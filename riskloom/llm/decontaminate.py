"""Benchmark decontamination over a distributed positional inverted index.

Method: documents are dealt to shards of bounded size; each shard stores, for every term of the test items, the list
of its positions (a table in the shared folder). To find an exact phrase, a shard starts from the list of the
phrase's rarest term there, shifts it by the term's offset, and intersects it with the other terms' shifted lists,
rarest first. Proximity search asks for every other term within some words of the rarest one. Postings are sharded by
document, so a term that every document holds makes long lists everywhere instead of one huge list, and no pair of
documents ever meets. Test items reach the tasks in slices of a bounded number of words.

Defined results: null texts have no words; an item of fewer words than a window, but not none, is one window; an item
without an id marks words but is not listed; repeated item rows count once; repeated document rows are answered each.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import id_and_text, map_arrow, original_id, stored, unused

WINDOW = 10
SHARD_WORDS = 2_000_000
PAD = 64  # free positions between documents; also the largest proximity
#: Words of the test items that one broadcast holds.
SLICE_WORDS = 2_000_000

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words(body: bytes) -> list[bytes]:
    """Lower-cased words: digits, a-z and whatever lies beyond ASCII."""
    return body.translate(_WORDS).split()


def item_slices(items: DataFrame, key: str, text: str, slice_words: int = SLICE_WORDS):
    """How many slices there are, then the items of each, as (id, words): about ``slice_words`` words a slice; the
    driver holds one at a time."""
    made = items.select(F.col(f"`{key}`").cast("string").alias("item"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body")).distinct()
    size = made.agg(F.sum(F.length("body"))).first()[0] or 0
    n = max(1, math.ceil(size / 2 / slice_words))  # a word and its space take two characters at least
    yield n
    for k in range(n):
        own = made.filter(F.pmod(F.xxhash64("item", "body"), F.lit(n)) == k)
        yield [(r.item, found) for r in own.collect() if (found := words(r.body.encode()))]


def _postings(vocabulary):
    def over(batches):
        context = TaskContext.get()
        shard, terms = context.partitionId() << 24, vocabulary.value
        rows, ids, lengths, found = [], [], [], []

        def whole():
            nonlocal shard
            if not ids:
                return
            starts = np.cumsum([0, *(n + PAD for n in lengths[:-1])])
            every = np.concatenate(found)
            at = np.concatenate([s + np.arange(n) for s, n in zip(starts, lengths)])
            at, every = at[every >= 0], every[every >= 0]
            order = np.argsort(every, kind="stable")
            at, every = at[order], every[order]
            cuts = np.flatnonzero(np.diff(every)) + 1
            lists = np.split(at, cuts) if len(at) else []
            packed = [pack(x) for x in lists]
            n = len(packed)
            yield {"shard": [shard] * (n + 1), "term": [-1, *(every[np.r_[0, cuts]].tolist() if n else [])],
                   "positions": [np.array([rows, ids, lengths], "<i8").tobytes(), *packed]}
            shard += 1
            rows.clear(), ids.clear(), lengths.clear(), found.clear()

        total = 0
        for batch in batches:
            for row, i, body in zip(*(batch.column(c).to_pylist() for c in ("row", "id", "body"))):
                get = terms.get
                own = np.array([get(w, -1) for w in words(body)], np.int32)
                rows.append(row), ids.append(i), lengths.append(len(own)), found.append(own)
                total += len(own) + PAD
                if total >= SHARD_WORDS:
                    yield from whole()
                    total = 0
        yield from whole()

    schema = pa.schema([("shard", pa.int64()), ("term", pa.int32()), ("positions", pa.binary())])

    def made(batches):
        for columns in over(batches):
            yield pa.RecordBatch.from_pydict({f.name: pa.array(columns[f.name], f.type) for f in schema}, schema=schema)
    return made


def pack(positions: np.ndarray) -> bytes:
    """Gaps between positions in as few bytes as the largest needs; the first byte tells the width."""
    gaps = np.diff(positions, prepend=0)
    width = next(w for w in (1, 2, 4, 8) if int(gaps.max()) < 256**w)
    return bytes([width]) + gaps.astype(f"<u{width}").tobytes()


def unpack(held: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(held, f"<u{held[0]}", offset=1), dtype=np.int64)


def build_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Store (shard, term, positions) of (row, id, body); term -1 has the rows, ids and lengths of the shard's documents."""
    terms = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return stored(docs.mapInArrow(_postings(terms), "shard long, term int, positions binary"), "postings")


def _held(lists: dict, term: int) -> np.ndarray:
    if isinstance(lists[term], bytes):
        lists[term] = unpack(lists[term])
    return lists[term]


def phrase(lists: dict, size: dict, terms: list[int]) -> np.ndarray:
    """Start positions of the exact phrase."""
    order = sorted(range(len(terms)), key=lambda k: size[terms[k]])
    at = _held(lists, terms[order[0]]) - order[0]
    for k in order[1:]:
        other = _held(lists, terms[k])
        where = np.searchsorted(other, at + k)
        at = at[(where < len(other)) & (other[np.minimum(where, len(other) - 1)] == at + k)]
        if not len(at):
            break
    return at


def near(lists: dict, size: dict, terms: list[int], within: int) -> np.ndarray:
    """Positions of the rarest term that have every other term at most ``within`` words away."""
    order = sorted(set(terms), key=size.__getitem__)
    at = _held(lists, order[0])
    for term in order[1:]:
        other = _held(lists, term)
        where = np.searchsorted(other, at - within)
        at = at[(where < len(other)) & (other[np.minimum(where, len(other) - 1)] <= at + within)]
    return at


def _search(queries, within: int | None):
    def search(group):
        terms, held = group.column("term").to_pylist(), group.column("positions").to_pylist()
        lists = dict(zip(terms, held))
        rows, _, lengths = np.frombuffer(lists.pop(-1), "<i8").reshape(3, -1)
        size = {t: (len(b) - 1) // b[0] for t, b in lists.items()}
        starts = np.cumsum(np.r_[0, lengths[:-1] + PAD]) if len(lengths) else np.zeros(0, int)
        out = [], [], [], []
        for item, text in queries.value:
            width = min(WINDOW, len(text))
            present = np.cumsum([0, *(t in size for t in text)])
            found = []
            for s in np.flatnonzero(present[width:] - present[:-width] == width):
                own = text[s : s + width]
                found.append(phrase(lists, size, own) if within is None else near(lists, size, own, within))
            at = np.unique(np.concatenate(found)) if found else np.zeros(0, int)
            if not len(at):
                continue
            width = width if within is None else 1
            doc = np.searchsorted(starts, at, side="right") - 1
            fresh = np.r_[True, (np.diff(at) > width) | (np.diff(doc) > 0)]  # overlapping occurrences become one stretch
            first = np.flatnonzero(fresh)
            last = np.r_[first[1:] - 1, len(at) - 1]
            out[0].extend(rows[doc[first]].tolist())
            out[1].extend([item] * len(first))
            out[2].extend((at[first] - starts[doc[first]]).tolist())
            out[3].extend((at[last] - starts[doc[first]] + width).tolist())
        return pa.table({"row": pa.array(out[0], pa.int64()), "item": pa.array(out[1], pa.string()),
                         "start": pa.array(out[2], pa.int64()), "stop": pa.array(out[3], pa.int64())})
    return search


def _documents(batch: pa.RecordBatch):
    for held in batch.column(0).to_pylist():
        rows, ids, lengths = np.frombuffer(held, "<i8").reshape(3, -1)
        yield {"row": rows, "id": ids, "n_words": lengths}


def matches(docs: DataFrame, items: DataFrame, item_key: str = "item_id", item_text: str = "text",
            within: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, stretches): (row, id, n_words) of each row of (id, body), and (row, item, start, stop), the words
    that occurrences of the item's windows cover. With ``within``, the words near which a window's terms all occur."""
    if within is not None and not 0 <= within <= PAD:
        raise ValueError(f"terms can be found near each other up to {PAD} words")
    spark, everything, rows = docs.sparkSession, None, None
    slices = item_slices(items, item_key, item_text)
    docs = docs.withColumn("row", F.monotonically_increasing_id())
    if next(slices) > 1:
        docs = stored(docs, "documents")  # with their rows, as each slice may find them dealt to other tasks
    for own in slices:
        vocabulary = {w: n for n, w in enumerate(sorted({w for _, text in own for w in text}))}
        queries = spark.sparkContext.broadcast([(item, [vocabulary[w] for w in text]) for item, text in own])
        index = build_index(docs, vocabulary)
        found = index.groupBy("shard").applyInArrow(_search(queries, within), "row long, item string, start long, stop long")
        if rows is None:
            rows = map_arrow(index.filter("term = -1").select("positions"), _documents, "row long, id long, n_words long")
        everything = found if everything is None else everything.unionByName(found)
    return rows, everything


def contamination(df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """Per row of ``df``: id, ``n_words``, ``n_hit``, ``n_items``, ``items`` (sorted as strings), ``contaminated``."""
    return _report(*matches(id_and_text(df, key, text), items, item_key, item_text)).withColumnRenamed("id", key)


def _report(rows: DataFrame, stretches: DataFrame) -> DataFrame:
    before = F.max("stop").over(W.partitionBy("row").orderBy("start", "stop", "item").rowsBetween(W.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("stop") - F.greatest("start", F.coalesce(before, F.lit(0))))
    hit = stretches.withColumn("fresh", fresh).groupBy("row").agg(
        F.sum("fresh").alias("n_hit"), F.array_sort(F.collect_set("item")).alias("items"))
    out = rows.join(hit, "row", "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    hits = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(original_id().alias("id"), "n_words", hits.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                      items.alias("items"), (hits > 0).alias("contaminated"))


def drop_contaminated(df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` in which no window of any item occurs, all columns as they are. Rows are numbered in a
    written copy, so none is taken for another."""
    row, = unused(df, "row")
    numbered = stored(df.withColumn(row, F.monotonically_increasing_id()), "numbered")
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    rows, stretches = matches(numbered.select(F.col(row).alias("id"), body.alias("body")), items)
    gone = rows.join(stretches.select("row").distinct(), "row", "left_semi").select(F.col("id").alias(row))
    return numbered.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])
