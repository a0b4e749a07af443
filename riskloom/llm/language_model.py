"""Language model scores: a log-bilinear model trained by noise-contrastive estimation.

Method: words have context and target vectors of DIMENSIONS numbers; a target's score after a context word is the
product of the context's vector, turned by a matrix, with the target's vector, plus the target's bias. Training in numpy
contrasts what follows each context in the training documents with unigram noise; the expectation over the noise is
taken exactly, by matrix products, from the counts of all adjacent pairs.

Nothing bounds the vocabulary: it is the WORDS * sqrt(N) most frequent of N training tokens, so the pairs of words that
the model weighs are as many as the tokens, and one pass over them costs the same per token at every size. Pair counts
stay in Spark as tiles of SIDE contexts by SIDE targets, words dealt in turn so that frequent ones spread over all
tiles. A step of the training is one job: tasks turn tiles into slopes, which are added by Spark; the driver holds the
parameters, their moments and one sum of slopes, which grow with the square root of the corpus. A further job over the
tiles gives each context its normaliser, so the probability of a token is one product of two vectors. Other tokens
share one class whose members are told apart by their add-one counts, with one more place for the unseen: probabilities
of all texts sum to one.

Counts cover every training document and token. Documents are dealt to shards of bounded size; a shard numbers its own
tokens, and only its distinct tokens are shuffled to meet their counts in the whole corpus and to come back as numbers.
A token has at most one row a shard there, so no token outweighs others.

Defined results: null and empty texts are the end token alone; a null id belongs to the training part; repeated rows
each count and are each scored; with no training documents every token is unseen. Slopes are added in any order, so
scores of two runs may differ in their last digits.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import NO_ID, group_bounds, id_and_text, original_id, stored

WORDS = 1.0  # words of the model for each square root of the training tokens
DIMENSIONS, NOISE, STEPS, RATE, DECAY = 24, 8, 40, 0.1, 20.0
SIDE = 512  # contexts and targets of a tile
FOLDS, HELD_OUT = 7, 2
SHARD_TOKENS = 4_000_000
END = b""  # no word is empty
_WIDE = 65535


def held_out(key: int | None) -> bool:
    return key is not None and zlib.crc32(str(key).encode()) % FOLDS == HELD_OUT


def tokens(body: bytes) -> list[bytes]:
    return [*body.lower().split(), END]  # bytes: A-Z and ASCII white space only


def _narrow(ids: np.ndarray) -> tuple[bytes, bytes]:
    """Two bytes for most ids; the rest follow in four."""
    wide = ids >= _WIDE
    return np.where(wide, _WIDE, ids).astype("<u2").tobytes(), ids[wide].astype("<u4").tobytes()


def _widen(short: bytes, rest: bytes) -> np.ndarray:
    ids = np.frombuffer(short, "<u2").astype(np.int64)
    ids[ids == _WIDE] = np.frombuffer(rest, "<u4")
    return ids


_SHARDS = "shard long, token binary, local int, seen long, docs binary, short binary, wide binary"


def _encode(batches):
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    names = ["shard", "token", "local", "seen", "docs", "short", "wide"]
    shard = TaskContext.get().partitionId() << 24
    numbers: dict[bytes, int] = {}
    docs, texts, total = [], [], 0

    def whole():
        nonlocal shard, total
        ids = np.concatenate(texts)
        lengths = np.array([len(x) for x in texts])
        out = np.array([d[1] for d in docs], bool)
        times = np.bincount(ids, minlength=len(numbers))
        seen = np.bincount(ids[np.repeat(~out, lengths)], minlength=len(numbers))
        order = np.argsort(-times, kind="stable")  # frequent tokens get small numbers
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        listed = list(numbers)
        for s in range(0, len(order), 20_000):
            own = order[s : s + 20_000]
            n = len(own)
            yield pa.RecordBatch.from_arrays([pa.array([shard] * n, kinds[0]), pa.array([listed[k] for k in own.tolist()], kinds[1]),
                                              pa.array(np.arange(s, s + n), kinds[2]), pa.array(seen[own], kinds[3]), *(pa.nulls(n, k) for k in kinds[4:])], names)
        about = np.array([[d[0] for d in docs], out, lengths], "<i8").tobytes()
        short, wide = _narrow(place[ids])
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((shard, None, None, None, about, short, wide), kinds)], names)
        shard, total = shard + 1, 0
        numbers.clear(), docs.clear(), texts.clear()

    for batch in batches:
        for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = tokens(body)
            texts.append(np.array([numbers.setdefault(w, len(numbers)) for w in own], np.int32))
            docs.append((key, held_out(None if key == NO_ID else key)))
            total += len(own)
            if total >= SHARD_TOKENS:
                yield from whole()
    if docs:
        yield from whole()


def shards(docs: DataFrame) -> DataFrame:
    """Store the shards of (id, body): a row for each distinct token of a shard, and one with its documents."""
    return stored(docs.mapInArrow(_encode, _SHARDS), "shards")


def counted(parts: DataFrame) -> DataFrame:
    """(shard, local, count, first, mark): the training count of each shard's tokens in the whole corpus."""
    same = W.partitionBy("token")
    own = parts.filter("token IS NOT NULL").select("shard", "local", "seen", "token")
    return stored(own.select("shard", "local", F.sum("seen").over(same).alias("count"),
                             (F.row_number().over(same.orderBy("shard")) == 1).alias("first"), F.xxhash64("token").alias("mark"),
                             (F.octet_length("token") == 0).alias("ends")), "counted")


def _slopes(cells, times, predicted, target, bias, false, unigram):
    """Of a tile, the slopes towards ``predicted`` and towards (target, bias). ``cells`` are the places of pairs that
    were seen, ``times`` their shares of all pairs; ``false`` and ``unigram`` make up the shares of the noise."""
    true = predicted @ target.T
    true += bias - np.log(unigram)
    np.clip(true, -30, 30, out=true)
    np.negative(true, out=true)
    np.exp(true, out=true)
    true += 1
    np.reciprocal(true, out=true)  # chance that a pair is data
    seen = times * (1 - true.ravel()[cells])
    error = true
    error *= -false[:, None]
    error *= unigram
    error.ravel()[cells] += seen
    return error @ target, np.column_stack([error.T @ predicted, error.sum(axis=0)])


class Matrix:
    """Pair counts held as one matrix; the plain counterpart of ``Tiles``."""

    def __init__(self, pairs: np.ndarray):
        contexts, outputs = pairs.shape
        self.cells = np.flatnonzero(pairs)
        self.times = pairs.ravel()[self.cells].astype(float)
        self.before, self.follows = pairs.sum(axis=1).astype(float), pairs.sum(axis=0).astype(float)

    def slopes(self, predicted, target, bias, false, unigram):
        total = max(self.before.sum(), 1)
        return _slopes(self.cells, self.times / total, predicted, target, bias, false, unigram)


def _added(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for key, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part = np.frombuffer(part, "<f8")
            sums[key] = sums[key] + part if key in sums else part
    yield from _parts(sums)


def _parts(sums):
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["part", "sums"])


class Tiles:
    """Pair counts as a stored table of tiles. Context c lies in tile row c mod ``down``, target t in tile column t mod
    ``across``."""

    def __init__(self, tiles: DataFrame, contexts: int, outputs: int):
        self.tiles, self.contexts, self.outputs = tiles, contexts, outputs
        self.down, self.across = -(-contexts // SIDE), -(-outputs // SIDE)
        self.before, self.follows = (x[:, 0] for x in self._sums(_marginals, None, 1, 1))

    def _sums(self, work, held, high: int, wide: int):
        """Sums over all tiles of what ``work`` returns: one array for the tile's contexts, one for its targets."""
        down, across, contexts, outputs = self.down, self.across, self.contexts, self.outputs

        def over(batches):
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for tile, cells, times in zip(*(batch.column(c).to_pylist() for c in range(3))):
                    row, column = divmod(tile, across)
                    found = work(np.frombuffer(cells, "<i4"), np.frombuffer(times, "<i8"), held and held.value, slice(row, contexts, down), slice(column, outputs, across))
                    for key, x in zip((row, down + column), found):
                        x = x.astype(float).ravel()
                        sums[key] = sums[key] + x if key in sums else x
            yield from _parts(sums)

        kinds = "part long, sums binary"
        found = self.tiles.mapInArrow(over, kinds).repartition("part").mapInArrow(_added, kinds).toArrow()
        first, second = np.zeros((contexts, high)), np.zeros((outputs, wide))
        for key, part in zip(found.column("part").to_pylist(), found.column("sums").to_pylist()):
            part = np.frombuffer(part, "<f8")
            own = first[key::down] if key < down else second[key - down :: across]
            own[:] = part.reshape(own.shape)
        return first, second

    def slopes(self, predicted, target, bias, false, unigram):
        held = self.tiles.sparkSession.sparkContext.broadcast(
            (max(self.before.sum(), 1), *(x.astype(np.float32) for x in (predicted, target, bias, false, unigram))))
        found = self._sums(_tile_slopes, held, predicted.shape[1], target.shape[1] + 1)
        held.unpersist()
        return found

    def normalisers(self, predicted, target, bias) -> np.ndarray:
        """The logarithm of each context's sum over all targets."""
        shift = (predicted @ target.mean(axis=0)) + bias.max()
        held = self.tiles.sparkSession.sparkContext.broadcast((predicted, target, bias, shift))
        return shift + np.log(self._sums(_tile_norms, held, 1, 0)[0][:, 0])


def _side(part: slice) -> int:
    return len(range(part.start, part.stop, part.step))


def _marginals(cells, times, held, own, to):
    wide = _side(to)
    return np.bincount(cells // wide, times, _side(own)), np.bincount(cells % wide, times, wide)


def _tile_slopes(cells, times, held, own, to):
    total, predicted, target, bias, false, unigram = held
    return _slopes(cells, (times / total).astype(np.float32), predicted[own], target[to], bias[to], false[own], unigram[to])


def _tile_norms(cells, times, held, own, to):
    predicted, target, bias, shift = held
    return np.exp(np.clip(predicted[own] @ target[to].T + bias[to] - shift[own, None], -700, 700)).sum(axis=1), np.zeros(0)


class LogBilinear:
    """Log-probabilities of targets after contexts, from a matrix of pair counts or from ``Tiles``."""

    def __init__(self, pairs, dimensions: int = DIMENSIONS, noise: int = NOISE, steps: int = STEPS, rate: float = RATE,
                 decay: float = DECAY, seed: int = 7):
        pairs = pairs if isinstance(pairs, Tiles) else Matrix(pairs)
        rng = np.random.default_rng(seed)
        contexts, outputs = len(pairs.before), len(pairs.follows)
        total = max(pairs.before.sum(), 1)
        unigram = (pairs.follows + 1) / (pairs.follows.sum() + outputs)
        self.context = 0.1 * rng.standard_normal((contexts, dimensions))
        self.turn = np.eye(dimensions)
        self.target = 0.1 * rng.standard_normal((outputs, dimensions))
        self.bias = np.log(unigram)
        loss = decay / total  # of squared vectors, so that few pairs change little
        held = [self.context, self.turn, self.target, self.bias]
        first, second = [np.zeros_like(x) for x in held], [np.zeros_like(x) for x in held]
        for step in range(1, steps + 1):
            back, toward = pairs.slopes(self.predicted(), self.target, self.bias, pairs.before / total, noise * unigram)
            slopes = [back @ self.turn.T - loss * self.context, self.context.T @ back, toward[:, :-1] - loss * self.target, toward[:, -1]]
            for x, g, m, v in zip(held, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                x += rate * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)

    def predicted(self) -> np.ndarray:
        return self.context @ self.turn

    def log10(self) -> np.ndarray:
        scores = self.predicted() @ self.target.T + self.bias
        top = scores.max(axis=1, keepdims=True)
        return (scores - top - np.log(np.exp(scores - top).sum(axis=1, keepdims=True))) / np.log(10)


def _words(group, size: int, bound: int) -> np.ndarray:
    """Model number of each local token; ``bound`` where it has none."""
    word = np.full(size, bound, np.int64)
    local, own = group.column("local").to_numpy(), group.column("word").to_numpy(zero_copy_only=False)
    given = ~np.isnan(own.astype(float))
    word[local[given]] = own[given].astype(np.int64)
    return word


def _each(documents):
    """(ids, held out, lengths, local tokens) of each stored part of a shard."""
    for about, short, wide in zip(*(documents.column(c).to_pylist() for c in ("docs", "short", "wide"))):
        ids, out, lengths = np.frombuffer(about, "<i8").reshape(3, -1)
        yield ids, out.astype(bool), lengths, _widen(short, wide)


def _before(sequence: np.ndarray, lengths: np.ndarray, begin: int) -> np.ndarray:
    context = np.r_[begin, sequence[:-1]]
    context[np.cumsum(lengths) - lengths] = begin
    return context


def _pairs(bound: int, down: int, across: int):
    """Training pairs of a shard by tile. Numbers: words up to bound, bound for others, bound + 1 the start."""
    contexts, outputs = bound + 2, bound + 1

    def run(vocabulary, documents):
        found = []
        for _, out, lengths, local in _each(documents):
            sequence = _words(vocabulary, int(local.max()) + 1 if len(local) else 0, bound)[local]
            keep = np.repeat(~out, lengths)
            before, after = _before(sequence, lengths, bound + 1)[keep], sequence[keep]
            row, column = before % down, after % across
            wide = (outputs - column + across - 1) // across
            found.append((row * across + column) << 32 | (before // down) * wide + after // across)
        code, times = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
        edges = group_bounds(code >> 32)
        parts = [_narrow(times[s:e]) for s, e in zip(edges[:-1], edges[1:])]
        return pa.table({"tile": pa.array((code >> 32)[edges[:-1]] if len(code) else [], pa.int64()),
                         "cells": pa.array([(code[s:e] & 0xFFFFFFFF).astype("<i4").tobytes() for s, e in zip(edges[:-1], edges[1:])], pa.binary()),
                         "short": pa.array([x for x, _ in parts], pa.binary()), "wide": pa.array([x for _, x in parts], pa.binary())})
    return run


def _tile(group):
    """One row of a tile's rows from all shards."""
    rows = [*zip(*(group.column(c).to_pylist() for c in ("cells", "short", "wide")))]
    cells = np.concatenate([np.frombuffer(c, "<i4") for c, _, _ in rows])
    times = np.concatenate([_widen(s, w) for _, s, w in rows])
    cells, place = np.unique(cells, return_inverse=True)
    sums = np.zeros(len(cells), "<i8")
    np.add.at(sums, place, times)
    return pa.table({"tile": group.column("tile")[:1], "cells": pa.array([cells.astype("<i4").tobytes()], pa.binary()), "times": pa.array([sums.tobytes()], pa.binary())})


def tiles(named: DataFrame, documents: DataFrame, bound: int) -> Tiles:
    """All training pairs; tiles without any have a row too, as the noise falls on them."""
    down, across = -(-(bound + 2) // SIDE), -(-(bound + 1) // SIDE)
    kinds = "tile long, cells binary, short binary, wide binary"
    own = named.filter("word IS NOT NULL").groupBy("shard").cogroup(documents.groupBy("shard")).applyInArrow(_pairs(bound, down, across), kinds)
    none = F.lit(b"")
    every = named.sparkSession.range(down * across).select(F.col("id").alias("tile"), none.alias("cells"), none.alias("short"), none.alias("wide"))
    made = own.unionByName(every).groupBy("tile").applyInArrow(_tile, "tile long, cells binary, times binary")
    return Tiles(stored(made, "tiles"), bound + 2, bound + 1)


def _score(table, bound: int, total: int, types: int, other_tokens: int, other_types: int):
    def run(vocabulary, documents):
        rows = [], [], [], [], [], []
        predicted, target, bias, norms = table.value
        for ids, out, lengths, local in _each(documents):
            if not len(ids):
                continue
            size = vocabulary.num_rows
            word = _words(vocabulary, size, bound)
            count = np.zeros(size, np.int64)
            count[vocabulary.column("local").to_numpy()] = vocabulary.column("count").to_numpy()
            base = np.log10((count + 1) / (total + types + 1))
            own = np.where(word == bound, np.log10((count + 1) / (other_tokens + other_types + 1)), 0.0)
            sequence = word[local]
            starts = np.cumsum(lengths) - lengths
            rows[0].extend(ids.tolist()), rows[1].extend(out.tolist()), rows[2].extend(lengths.tolist())
            rows[3].extend(np.add.reduceat((count > 0)[local].astype(np.int64), starts).tolist())
            rows[4].extend(np.add.reduceat(base[local], starts).tolist())
            before, logs = _before(sequence, lengths, bound + 1), np.empty(len(local))
            for s in range(0, len(local), 50_000):
                b, w = before[s : s + 50_000], sequence[s : s + 50_000]
                logs[s : s + 50_000] = (np.einsum("ij,ij->i", predicted[b], target[w]) + bias[w] - norms[b]) / math.log(10)
            rows[5].extend(np.add.reduceat(logs + own[local], starts).tolist())
        names = ("id", "held_out", "n_tokens", "n_known", "base_score", "score")
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table({n: pa.array(r, k) for n, r, k in zip(names, rows, kinds)})
    return run


def score(df: DataFrame, key: str = "doc_id", text: str = "text", words: float = WORDS, **training) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = df.sparkSession
    parts = shards(id_and_text(df, key, text))
    known = counted(parts)
    per_token = known.filter("first")
    sums = per_token.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.count_if(F.col("count") > 0).alias("v")).first()
    # the end token and the most frequent others; they grow with the square root of the training tokens
    vocabulary = 1 + math.ceil(words * math.sqrt(sums["n"]))
    chosen = per_token.filter("count > 0 OR ends").orderBy(F.col("ends").desc(), F.col("count").desc(), "mark").limit(vocabulary).select("mark", "count").collect()
    bound = len(chosen)
    listed = spark.createDataFrame([(r["mark"], n) for n, r in enumerate(chosen)], "mark long, word int")
    named = known.select("shard", "local", "count", "mark").join(F.broadcast(listed), "mark", "left").drop("mark")
    documents = parts.filter("docs IS NOT NULL").select("shard", "docs", "short", "wide")
    pairs = tiles(named, documents, bound)
    model = LogBilinear(pairs, **training)
    norms = pairs.normalisers(model.predicted(), model.target, model.bias)
    table = spark.sparkContext.broadcast((model.predicted(), model.target, model.bias, norms))
    in_model = sum(r["count"] for r in chosen)
    work = _score(table, bound, sums["n"], sums["v"], sums["n"] - in_model, sums["v"] - sum(r["count"] > 0 for r in chosen))
    out = named.groupBy("shard").cogroup(documents.groupBy("shard")).applyInArrow(
        work, "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select(original_id().alias(key), "held_out", "n_tokens", "n_known", F.lit(sums["n"]).cast("long").alias("train_tokens"), "base_score", "score")
