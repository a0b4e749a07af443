import collections
import math
import re
import zlib

import numpy as np
import pytest
import xxhash

from riskloom.llm import language_model
from riskloom.llm.language_model import LogBilinear, score


def plain(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0D]+", lower) if w] + [None]


def brute(rows):
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    seen = collections.Counter(w for i, t in rows if not out(i) for w in plain(t))
    n, v = sum(seen.values()), len(seen)
    return sorted(((i, out(i), len(w := plain(t)), sum(seen[x] > 0 for x in w), n, sum(math.log10((seen[x] + 1) / (n + v + 1)) for x in w)) for i, t in rows), key=repr)


def same(found, rows):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=repr)
    want = brute(rows)
    got.sort(key=lambda r: (repr(r[:5]), r[5]))
    want.sort(key=lambda r: (repr(r[:5]), r[5]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-12)


def test_whole_small_table(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    found = score(docs).collect()
    same(found, [tuple(r) for r in docs.select("doc_id", "text").collect()])
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_edges_and_small_shards(spark, monkeypatch):
    rows = [(None, "a b A"), (1, None), (2, ""), (2, "a\x1cb a"), (2, "a\x1cb a"), *((i, f"the cat w{i} sat ÄÖ") for i in range(3, 60)), (77, "x " * 70_000 + " ".join(f"n{i}" for i in range(70_000)))]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double").repartition(3)
    same(score(docs).collect(), rows)
    assert score(docs.limit(0)).count() == 0
    monkeypatch.setattr(language_model, "SHARD_TOKENS", 50)
    same(score(docs.filter("doc_id < 60")).collect(), [r for r in rows if r[0] is not None and r[0] < 60])
    only = spark.createDataFrame([(5, "a b"), (12, "c")], "doc_id long, text string")
    kept = [r for r in [(i, "a b") for i in range(60)] if zlib.crc32(str(r[0]).encode()) % 7 == 2]
    same(score(spark.createDataFrame(kept, only.schema)).collect(), kept)


def test_probabilities_sum_to_one(spark):
    """Over all texts of one word, seen or not, after the start and before the end."""
    rows = [(i, t) for i, t in enumerate(["a b", "a c", "b b d", "a"] * 5) if zlib.crc32(str(i).encode()) % 7 != 2]
    vocabulary = ["a", "b", "c", "d", "unseen"]
    probes = [(i, w) for i, w in zip((k for k in range(1000, 9999) if zlib.crc32(str(k).encode()) % 7 == 2), vocabulary)]
    found = {r.doc_id: r.score for r in score(spark.createDataFrame(rows + probes, "doc_id long, text string"), words=0.25).collect()}
    total = sum(10 ** found[i] for i, _ in probes)
    assert 0 < total < 1


def test_model_learns_pairs():
    rng = np.random.default_rng(0)
    truth = rng.dirichlet(np.full(30, 0.1), 31)
    pairs = np.array([rng.multinomial(4000, p) for p in truth])
    logs = LogBilinear(pairs, steps=400).log10()
    assert np.allclose((10**logs).sum(axis=1), 1)
    fitted = (truth * logs).sum() / 31
    unigram = (truth * np.log10(pairs.sum(axis=0) / pairs.sum())).sum() / 31
    assert fitted > unigram + 0.25
    with pytest.raises(ValueError):
        LogBilinear(np.zeros(3))


def plain_scores(rows, words, **training):
    """From texts to scores with dictionaries and one matrix of pairs."""
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    seen = collections.Counter(w for i, t in rows if not out(i) for w in plain(t))
    every = {w for _, t in rows for w in plain(t)}
    n, v = sum(seen.values()), len(seen)
    mark = lambda w: (xxhash.xxh64((w or "").encode(), seed=42).intdigest() + 2**63) % 2**64  # noqa: E731  signed order
    ranked = sorted((w for w in every if seen[w] or w is None), key=lambda w: (w is not None, -seen[w], mark(w)))
    number = {w: k for k, w in enumerate(ranked[: 1 + math.ceil(words * math.sqrt(n))])}
    bound = len(number)
    pairs = np.zeros((bound + 2, bound + 1))
    coded = [(i, t, [number.get(w, bound) for w in plain(t)]) for i, t in rows]
    for i, _, own in coded:
        if not out(i):
            for a, b in zip([bound + 1, *own], own):
                pairs[a, b] += 1
    logs = LogBilinear(pairs, **training).log10()
    rest, kinds = n - sum(seen[w] for w in number), v - sum(seen[w] > 0 for w in number)
    return {(i, t): sum(logs[a, b] + (math.log10((seen[w] + 1) / (rest + kinds + 1)) if b == bound else 0)
                        for a, b, w in zip([bound + 1, *own], own, plain(t))) for i, t, own in coded}


@pytest.mark.parametrize("side", [512, 7])
def test_plain_version(spark, tiny, monkeypatch, side):
    """Scores agree with those of a plain version, whether the pairs fill one tile or hundreds."""
    monkeypatch.setattr(language_model, "SIDE", side)
    monkeypatch.setattr(language_model, "SHARD_TOKENS", 3_000)
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").limit(60 if side == 512 else 25)
    docs = spark.createDataFrame(docs.collect() + [(None, "a b a"), (7_000_001, None), (7_000_001, "")], docs.schema).repartition(2)
    rows = [tuple(r) for r in docs.collect()]
    want = plain_scores(rows, 1.0, steps=8)
    got = score(docs.withColumn("score", docs.doc_id), steps=8).collect()
    assert np.allclose(sorted(r.score for r in got), sorted(want[r] for r in rows), rtol=1e-3, atol=1e-2)


def test_vocabulary_grows(spark):
    """Every pair count reaches the tiles, and four times the tokens give the model twice the words."""
    made = []
    for n in (400, 1600):
        docs = spark.createDataFrame([(i, " ".join(f"w{(i * k) % 997}" for k in range(20))) for i in range(n)], "doc_id long, text string")
        seen = []
        original = language_model.LogBilinear
        language_model.LogBilinear = lambda pairs, **kw: seen.append(pairs) or original(pairs, **kw)
        try:
            out = score(docs, steps=1)
            train = out.first().train_tokens
        finally:
            language_model.LogBilinear = original
        assert seen[0].before.sum() == seen[0].follows.sum() == train
        made.append(seen[0].outputs)
    assert 1.8 < made[1] / made[0] < 2.2
