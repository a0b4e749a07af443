import hashlib
import random
import re

import numpy as np

from riskloom.llm.rolling import BASES, from_planes, planes, rolling
from riskloom.llm.substring_dedup import dedup_substrings, intervals

NONE = 2**63 - 1


def plain(docs, window=13):
    split = [(NONE if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    first = {}
    for i, w in split:
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            first[k] = min(first.get(k, i), i)
    out = []
    for (i, _), (own, w) in zip(docs, split):
        gone = {p for s in range(len(w) - window + 1) if first[tuple(w[s : s + window])] < own for p in range(s, s + window)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df, **how):
    rows = dedup_substrings(df, **how).collect()
    for r in rows:
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256
        assert r.n_removed == sum(b - a for a, b in zip(r.starts or [], r.ends or []))
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=repr)


def made(seed, n=60, words=40):
    rng = random.Random(seed)
    pool = [f"w{k}" for k in range(words)] + ["é", "Ä.", "the"]
    passages = [[rng.choice(pool) for _ in range(rng.randint(5, 60))] for _ in range(6)]
    docs = []
    for i in range(n):
        own = []
        for _ in range(rng.randint(0, 5)):
            own += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(pool) for _ in range(rng.randint(0, 30))]
        docs.append((i, rng.choice([" ", "\n", "\t ", "\r\x0b"]).join(own)))
    return docs


def test_blocks_and_buckets_of_any_size(spark):
    docs = made(1) + [(None, " ".join(f"n{k}" for k in range(30)))] * 2 + [(None, None), (3, ""), (4, None), (70, " ".join(["same"] * 3000)), (71, " ".join(["same"] * 40))]
    docs += [(2, docs[2][1]), (1, docs[9][1])]  # repeated ids
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = plain(docs)
    assert found(df) == want
    assert found(df, block_words=50, bucket_windows=100) == want
    assert sum(w[2] for w in want) > 100


def test_other_window(spark):
    docs = made(2, 30)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(df, window=3, block_words=100, bucket_windows=50) == plain(docs, 3)


def test_empty_table_and_clashing_columns(spark):
    assert found(spark.createDataFrame([], "doc_id long, text string")) == []
    docs = made(3, 20)
    df = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in docs], "doc_id long, text string, id int, mark int, body int")
    assert found(df) == plain(docs)


def test_whole_text_copies_stay_once(spark):
    text = " ".join(f"x{k}" for k in range(500))
    got = found(spark.createDataFrame([(i, text) for i in range(40)], "doc_id long, text string").repartition(7), block_words=600)
    assert [g[2] for g in sorted(got)] == [0] + [500] * 39


def test_rolling_hash_is_the_polynomial():
    values = np.random.default_rng(0).integers(0, 2**64, 40, np.uint64)
    from riskloom.llm.rolling import mixed
    want = [sum(int(values[i + k]) * pow(BASES[0], 4 - k, 2**64) for k in range(5)) % 2**64 for i in range(36)]
    assert (rolling(values, 5, BASES[0]) == mixed(np.array(want, np.uint64))).all()
    assert len(rolling(values[:3], 5, BASES[0])) == 0
    at = np.array([0, 1, 5, 70000, 4_000_000_000])
    assert (from_planes(planes(at)) == at).all() and len(from_planes(None)) == 0
    assert [x.tolist() for x in intervals(np.array([0, 1, 14, 30]), 13)] == [[0, 30], [27, 43]]
