"""Collocations: phrases whose words occur together more often than their parts would suggest.

Method: prefix-free parsing. Texts are rows of words and separators; a chunk starts at every pair of tokens whose
Rabin-Karp hash is divisible by EVERY (and at the text's start) and reaches to the end of the next such pair, so chunks overlap
by one pair and equal passages fall into equal chunks wherever they stand. The dictionary of distinct chunks with their
parse frequencies is all that is counted further: an n-gram inside a chunk weighs as much as the chunk, and one that
starts in the closing overlap is left to the next chunk.

The dictionary is stored in blocks. A block adds up its n-grams by hash and sends eight bytes and a count for each to
the hash's bucket; the bucket comes from a second hash, so that bits are compared beside the 64 that are sent. Buckets
keep the n-grams that reach the least count and ask the first block that sent one for its words. Phrases then meet the
counts of their parts in joins on (language, phrase).

A frequent n-gram is one entry a block. Products are exact: decimals of 38 digits.

Defined results: null and empty texts have no words; a null language is ``und``; rows are counted each, also if they
repeat; other columns are not carried. Phrases of up to ``longest`` words count, ``longest`` at least 2.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import group_bounds, map_arrow, runs, stored
from riskloom.llm.rolling import BASES, arrays, by_bucket, each, mixed, rolling, word_values

LONGEST, LEAST_COUNT, TOP, COVERED_PERCENT = 3, 10, 2000, 50
#: One pair of tokens in so many starts a chunk.
EVERY = 16
BLOCK_WORDS = 600_000
#: About as many n-grams meet in a bucket, by WORD_BYTES a word.
BUCKET_NGRAMS, WORD_BYTES = 4_000_000, 6
UNKNOWN = "und"

_SEPARATOR = b"."
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else 46 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))


def tokens(body: bytes) -> list[bytes]:
    """Lower-cased words and, where pieces end, separators. No word holds a separator, space or tab."""
    return body.translate(_PLAIN).replace(_SEPARATOR, b" . ").split()


def chunk_bounds(triggers: np.ndarray, size: int, overlap: int) -> list[tuple[int, int]]:
    """Where the chunks of a text of ``size`` tokens start and end; ``triggers`` start at or after token 1."""
    starts = [0, *triggers.tolist()]
    return list(zip(starts, [*(t + overlap for t in starts[1:]), size]))


def _parse(overlap: int, every: int, block_words: int):
    schema = pa.schema([("lang", pa.string()), ("closes", pa.bool_()), ("chunk", pa.binary()), ("times", pa.int64())])

    def over(batches):
        texts, langs, held = [], [], 0
        for batch in batches:
            for lang, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = tokens(body)
                if own:
                    texts.append(own), langs.append(lang)
                    held += len(own)
                if held >= block_words:
                    yield made(texts, langs)
                    texts, langs, held = [], [], 0
        if texts:
            yield made(texts, langs)

    def made(texts, langs):
        values, _ = word_values([w for t in texts for w in t])
        hashes = rolling(values, overlap, BASES[0])
        triggers = np.flatnonzero(hashes % np.uint64(every) == 0)
        ends = np.cumsum([len(t) for t in texts])
        found, at = Counter(), 0
        for text, lang, end in zip(texts, langs, ends.tolist()):
            start = end - len(text)
            upto = int(np.searchsorted(triggers, end - overlap, side="right"))
            own = triggers[at:upto] - start
            at = int(np.searchsorted(triggers, end))
            bounds = chunk_bounds(own[own > 0], len(text), overlap)
            for a, b in bounds[:-1]:
                found[lang, False, b" ".join(text[a:b])] += 1
            a, b = bounds[-1]
            found[lang, True, b" ".join(text[a:b])] += 1
        columns = zip(*found)
        return pa.RecordBatch.from_arrays([*(pa.array(c, f.type) for c, f in zip(columns, schema)), pa.array(found.values(), pa.int64())], schema=schema)
    return over


_BLOCK = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("words", pa.int64()), ("chunks", pa.binary()), ("times", pa.binary()), ("closes", pa.binary())])
_BLOCK_TYPES = "block long, lang string, words long, chunks binary, times binary, closes binary"


def _pack(overlap: int, block_words: int):
    """Rows (lang, closes, chunk, times) into blocks of one language each."""
    def over(batches):
        block, held, size = TaskContext.get().partitionId() << 32, {}, 0
        for batch in batches:
            for lang, closes, chunk, times in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(lang, []).append((chunk, closes, times))
                size += chunk.count(b" ") + 1
                if size >= block_words:
                    yield made(held, block)
                    block, held, size = block + len(held), {}, 0
        if held:
            yield made(held, block)

    def made(held, block):
        small, rows = zstandard.ZstdCompressor(level=1), []
        for lang, found in held.items():
            words = 0
            for chunk, closes, times in found:
                own = chunk if closes else chunk.rsplit(b" ", overlap)[0]
                words += times * (own.count(b" ") + 1 - own.count(_SEPARATOR))
            rows.append({"block": block + len(rows), "lang": lang, "words": words, "chunks": small.compress(b"\n".join(c for c, _, _ in found)),
                         "times": small.compress(np.array([t for _, _, t in found], "<i8").tobytes()),
                         "closes": np.packbits([c for _, c, _ in found]).tobytes()})
        return pa.RecordBatch.from_pylist(rows, _BLOCK)
    return over


def _ngrams(row: dict, longest: int):
    """The block's tokens, and of all n-grams the two hashes, first tokens, lengths and weights."""
    whole = zstandard.ZstdDecompressor()
    chunks = [c.split(b" ") for c in whole.decompress(row["chunks"]).split(b"\n")]
    times, lengths = np.frombuffer(whole.decompress(row["times"]), "<i8"), np.array([len(c) for c in chunks], np.int64)
    closes = np.unpackbits(np.frombuffer(row["closes"], np.uint8))[: len(chunks)].astype(bool)
    every = [w for c in chunks for w in c]
    values = word_values(every)
    apart = np.cumsum(np.r_[0, values[0] == word_values([_SEPARATOR])[0]])
    at, ends = np.arange(len(every)), np.repeat(np.cumsum(lengths), lengths)
    own = at < ends - np.repeat(np.where(closes, 0, max(2, longest - 1)), lengths)
    weights = np.repeat(times, lengths)
    lang = word_values([b"\x00" + row["lang"].encode()])
    out = [], [], [], [], []
    for n in range(1, longest + 1):
        starts = at[: max(0, len(every) - n + 1)]
        starts = starts[own[starts] & (starts + n <= ends[starts]) & (apart[starts + n] == apart[starts])]
        for k in range(2):
            out[k].append(mixed(rolling(values[k], n, BASES[k])[starts] + lang[k]))
        out[2].append(starts), out[3].append(np.full(len(starts), n, np.int8)), out[4].append(weights[starts])
    return every, *(np.concatenate(x) for x in out)


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in as few bytes as the largest needs; the first byte tells the width."""
    width = next(w for w in (1, 2, 4, 8) if int(counts.max()) < 256**w)
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _wide(held: bytes) -> np.ndarray:
    return np.frombuffer(held, f"<u{held[0]}", offset=1).astype(np.int64)


def _counts(longest: int, buckets: int):
    def run(batch: pa.RecordBatch):
        for row in batch.to_pylist():
            _, one, two, _, _, weights = _ngrams(row, longest)
            if not len(one):
                continue
            order = np.argsort(one)
            one, two = one[order], two[order]
            cuts = np.flatnonzero(np.r_[True, one[1:] != one[:-1]])
            sums = np.add.reduceat(weights[order], cuts)
            one, two = one[cuts], two[cuts]
            found = list(by_bucket((two % np.uint64(buckets)).astype(np.int64), buckets))
            yield {"key": [b for b, _ in found], "block": [row["block"]] * len(found),
                   "hashes": [one[own].tobytes() for _, own in found], "counts": [_narrow(sums[own]) for _, own in found]}
    return run


def _frequent(least: int):
    """In a bucket: the n-grams of at least ``least`` occurrences, for the first block that sent each."""
    def run(group: pa.Table):
        hashes = arrays(group, "hashes", "<u8")
        sender = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        every, counts = np.concatenate(hashes), np.concatenate([_wide(b) for b in group.column("counts").to_pylist()])
        order = np.argsort(every, kind="stable")
        bounds = group_bounds(every[order])[:-1]
        sums = np.add.reduceat(counts[order], bounds)
        keep = sums >= least
        first, sums = order[bounds[keep]], sums[keep]
        to = np.argsort(sender[first], kind="stable")
        first, sums = first[to], sums[to]
        found, starts = np.unique(sender[first], return_index=True)
        cuts = starts[1:]
        if len(found):
            blocks = group.column("block").to_numpy()
            yield {"block": blocks[found], "bucket": np.full(len(found), group.column("key")[0].as_py(), np.int64),
                   "hashes": [x.tobytes() for x in np.split(every[first], cuts)], "counts": [x.tobytes() for x in np.split(sums, cuts)]}
    return run


def _spell(longest: int, buckets: int):
    """In a block: the words of the n-grams that buckets ask it for."""
    def run(group: pa.Table):
        rows = group.to_pylist()
        block = next(r for r in rows if r["chunks"] is not None)
        asked = [r for r in rows if r["chunks"] is None]
        if not asked:
            return
        every, one, two, starts, sizes, _ = _ngrams(block, longest)
        hashes = np.concatenate([np.frombuffer(r["hashes"], "<u8") for r in asked])
        bucket = np.repeat([r["bucket"] for r in asked], [len(r["hashes"]) // 8 for r in asked])
        counts = np.concatenate([np.frombuffer(r["counts"], "<i8") for r in asked])
        order = np.argsort(one, kind="stable")
        where = np.searchsorted(one[order], hashes)
        at = order[where]
        if not (one[at] == hashes).all() or not ((two[at] % np.uint64(buckets)).astype(np.int64) == bucket).all():
            raise ValueError("a block was asked for n-grams that it does not hold")
        yield {"lang": [block["lang"]] * len(at), "size": sizes[at].astype(np.int32), "total": counts,
               "phrase": [b" ".join(every[s : s + n]).decode("utf-8", "replace") for s, n in zip(starts[at].tolist(), sizes[at].tolist())]}
    return run


def dictionary(df: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, every: int = EVERY,
               block_words: int = BLOCK_WORDS) -> DataFrame:
    """Store the distinct chunks with their parse frequencies, in blocks; ``words`` is the weighted number of words."""
    overlap = max(2, longest - 1)
    docs = df.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"),
                     F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("body"))
    chunks = docs.mapInArrow(_parse(overlap, every, block_words), "lang string, closes boolean, chunk binary, times long")
    summed = chunks.groupBy("lang", "closes", "chunk").agg(F.sum("times").alias("times"))
    return stored(summed.mapInArrow(_pack(overlap, block_words), _BLOCK_TYPES), "dictionary")


def frequent_ngrams(blocks: DataFrame, size: int, longest: int = LONGEST, least: int = LEAST_COUNT, bucket_ngrams: int = BUCKET_NGRAMS) -> DataFrame:
    """Store the n-grams of at least ``least`` occurrences: ``lang``, ``size`` in words, ``phrase``, ``total``.
    ``size`` is about how many bytes of text the blocks stand for; it sets the number of buckets."""
    buckets = max(1, math.ceil(size / WORD_BYTES * longest / bucket_ngrams))
    sent = map_arrow(blocks, _counts(longest, buckets), "key long, block long, hashes binary, counts binary")
    asked = runs(sent, "key", each("key", _frequent(least)), "block long, bucket long, hashes binary, counts binary")
    both = blocks.drop("words").unionByName(asked, allowMissingColumns=True)
    return stored(runs(both, "block", each("block", _spell(longest, buckets)), "lang string, size int, total long, phrase string"), "ngrams")


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST_COUNT,
                 top: int = TOP, covered_percent: int = COVERED_PERCENT, every: int = EVERY, block_words: int = BLOCK_WORDS,
                 bucket_ngrams: int = BUCKET_NGRAMS) -> DataFrame:
    """Each language's ``top`` phrases: ``lang``, ``rank``, ``phrase``, its count ``a``, the counts ``l`` and ``r`` of
    the parts of its weakest cut, the language's words ``n``, and ``score``."""
    blocks = dictionary(df, text, lang, longest, every, block_words)
    size = df.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    ngrams = frequent_ngrams(blocks, size, longest, least, bucket_ngrams)
    counts = ngrams.select("lang", "phrase", "total")
    parts = F.split("phrase", " ")
    cut = lambda k: F.struct(F.lit(k).alias("k"), F.array_join(F.slice(parts, 1, k), " ").alias("first"),
                             F.array_join(F.slice(parts, F.lit(k + 1), F.lit(longest)), " ").alias("rest"))
    whole = ngrams.filter("size > 1").withColumnRenamed("total", "a")
    cuts = whole.withColumn("cut", F.explode(F.filter(F.array(*[cut(k) for k in range(1, longest)]), lambda c: c["rest"] != "")))
    cuts = cuts.select("lang", "phrase", "a", "cut.*")
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("total").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("total").alias("r"))
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    measured = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("top", exact("a") * exact("a")).withColumn(
        "below", exact("l") * exact("r")).withColumn("score", F.expr("(CAST(1000000 AS DECIMAL(7,0)) * CAST(top AS DECIMAL(31,0))) div below"))
    weakest = measured.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("c")).select("lang", "phrase", "c.*")
    spans = [F.struct(F.array_join(F.slice(parts, i, n), " ").alias("inner"), F.lit(i + n - 1).alias("last"), F.lit(n).alias("words"))
             for n in range(2, longest) for i in range(1, longest - n + 2)]
    if spans:
        inside = whole.filter("size > 2").withColumn("s", F.explode(F.filter(F.array(*spans), lambda s: (s["last"] <= F.col("size")) & (s["words"] < F.col("size")))))
        inside = inside.groupBy("lang", F.col("s.inner").alias("phrase")).agg(F.max("a").alias("longer"))
        weakest = weakest.join(inside, ["lang", "phrase"], "left").filter(
            F.col("longer").isNull() | (100 * F.col("longer") < covered_percent * F.col("a")))
    by = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = F.pmod(F.xxhash64("phrase"), F.lit(16))  # no task ranks all phrases of a language
    ranked = weakest.withColumn("place", F.row_number().over(W.partitionBy("lang", part).orderBy(*by))).filter(F.col("place") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*by)).cast("long")).filter(F.col("rank") <= top)
    words = blocks.groupBy("lang").agg(F.sum("words").alias("n"))
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
