import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from riskloom.llm.ranked_search import best, search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain(docs, items, k=20):
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    n, total = len(held), sum(len(w) for _, w in held)
    df = Counter(x for _, w in held for x in set(w))
    out = []
    for item, text in set(items):
        scored = []
        for i, w in held:
            tf, m, score = Counter(w), 100 - 25 + (25 * len(w) * n) // total, 0
            for x in terms(text):
                if tf[x]:
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * ((1000000000 * tf[x]) // (1000 * tf[x] + 12 * m))
            if score > 0:
                scored.append((-score, 2**63 - 1 if i is None else i, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def found(df, items, **how):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in search(df, items, **how).collect()), key=repr)


def made(seed, n=120):
    rng = random.Random(seed)
    pool = [f"t{int(rng.paretovariate(0.7)) % 60}" for _ in range(300)] + ["Été", "x.y", "A1"]
    docs = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 60)))) for i in range(n)]
    return docs, [(j, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for j in range(15)]


def test_against_every_document(spark):
    docs, items = made(1)
    docs += [(200 + k, docs[k % 7][1]) for k in range(40)] + [(None, docs[3][1]), (None, None), (300, ""), (5, docs[5][1]), (301, "t1 " * 4000)]
    items += [(0, items[0][1]), (50, None), (51, "nowhere"), (None, "t1 t1 T2")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    asked = spark.createDataFrame(items, "item_id long, text string")
    want = plain(docs, items)
    assert found(df, asked) == want
    assert found(df, asked, shard_words=200) == want
    assert found(df, asked, shard_words=200, slice_words=10) == want
    assert found(df, asked, k=3, shard_words=500) == plain(docs, items, 3)


def test_empty_tables_and_clashing_columns(spark):
    docs, items = made(2, 30)
    empty = spark.createDataFrame([], "doc_id long, text string")
    asked = spark.createDataFrame([(j, t, 1, 2) for j, t in items], "item_id long, text string, query int, score int")
    assert found(empty, asked) == [] and found(spark.createDataFrame(docs, "doc_id long, text string"), asked.limit(0)) == []
    df = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in docs], "doc_id long, text string, id int, rank int, slice int")
    assert found(df, asked) == plain(docs, items)


@pytest.mark.parametrize("seed", range(20))
def test_bounds_settle_membership_ties_and_scores(seed):
    rng = np.random.default_rng(seed)
    size, lists, total = 400, [], np.zeros(400, np.int64)
    for _ in range(rng.integers(1, 9)):
        docs = rng.choice(size, rng.integers(1, size), replace=False)
        values = rng.integers(1, 8, len(docs))
        total[docs] += values
        order = np.lexsort((docs, -values))
        lists.append((docs[order], values[order]))
    for k in (1, 10, 500):
        want = [d for d in np.lexsort((np.arange(size), -total)) if total[d]][:k]
        near, score = best(lists, size, k)
        assert near.tolist() == want and score.tolist() == total[want].tolist()
        floor = int(total[want[-1]])
        assert best(lists, size, k, floor)[0].tolist() == want
