import random
import re
from collections import Counter

import pytest

from riskloom.llm.collocations import collocations, dictionary


def plain(docs, longest=3, least=10, top=2000, covered=50):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if c.isascii() else c for c in text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[s : s + k]) for k in range(1, longest + 1) for s in range(len(w) - k + 1))
    whole = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = {}
    for p, a in whole.items():
        lang, w = p[0], p[1:]
        if any(q[0] == lang and len(q) > len(p) and 100 * b >= covered * a and
               any(q[s : s + len(w)] == w for s in range(1, len(q) - len(w) + 1)) for q, b in whole.items()):
            continue
        score, k = min((1000000 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    return sorted((lang, r + 1, p.decode(), -a, l, q, n[lang], -s) for lang, own in out.items()
                  for r, (s, a, p, l, q) in enumerate(sorted(own)[:top]))


def found(df, **how):
    return sorted(tuple(r) for r in collocations(df, **how).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def made(seed, n=150):
    rng = random.Random(seed)
    pool = ["the", "of", "New", "york", "city", "HALL", "é", "ü1", "x-y", "a\x00b"] + [f"w{k}" for k in range(25)]
    passages = [" ".join(rng.choice(pool) for _ in range(40)) for _ in range(3)]
    docs = []
    for _ in range(n):
        text = []
        for _ in range(rng.randint(0, 40)):
            r = rng.random()
            text.append("New York city hall" if r < 0.1 else "New york" if r < 0.15 else rng.choice(pool) + rng.choice(["", "", "", ".", ",", "\n", " ;;\t"]))
        docs.append((rng.choice(["en", "fr", None]), " ".join(text) + (" " + rng.choice(passages) if rng.random() < 0.3 else "")))
    return docs


@pytest.mark.parametrize("every", [1, 3, 16, 10**9])
def test_counts_do_not_depend_on_the_chunks(spark, every):
    docs = made(1) + [("en", None), (None, ""), ("de", "..."), ("und", "one two " * 30), ("", "the the the the " * 300)]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    want = plain(docs)
    assert {w[0] for w in want} == {"en", "fr", "und", ""}
    assert found(df, every=every, block_words=300, bucket_ngrams=500) == want


def test_other_limits_and_production_blocks(spark):
    docs = made(2, 80)
    df = spark.createDataFrame(docs, "lang string, text string")
    assert found(df, longest=2, top=5) == plain(docs, 2, top=5)
    assert found(df, longest=4, least=4, covered_percent=80) == plain(docs, 4, 4, covered=80)


def test_equal_texts_are_one_chunk_row(spark):
    text = "alpha beta gamma. delta " * 50
    df = spark.createDataFrame([("en", text)] * 400, "lang string, text string").repartition(4)
    blocks = dictionary(df, every=8).collect()
    assert sum(r.words for r in blocks) == 400 * 200
    assert sum(len(r.chunks) for r in blocks) < 2000
    assert found(df) == plain([("en", text)] * 400)


def test_empty_table_and_clashing_columns(spark):
    assert found(spark.createDataFrame([], "lang string, text string")) == []
    docs = made(3, 60)
    df = spark.createDataFrame([(x, t, 1, 2, 3) for x, t in docs], "lang string, text string, block int, phrase int, total int")
    assert found(df) == plain(docs)


def test_products_beyond_64_bits(spark):
    """Counts of a few million make products over 2^63; decimals hold them."""
    from pyspark.sql import functions as F
    row = spark.range(1).select(F.lit(10**13).alias("a"), F.lit(3 * 10**13).alias("l"), F.lit(7 * 10**13).alias("r"))
    top = F.col("a").cast("decimal(20,0)") * F.col("a").cast("decimal(20,0)")
    below = F.col("l").cast("decimal(20,0)") * F.col("r").cast("decimal(20,0)")
    got = row.select(top.alias("top"), below.alias("below")).selectExpr("(CAST(1000000 AS DECIMAL(7,0)) * CAST(top AS DECIMAL(31,0))) div below AS s").first()
    assert got.s == 10**6 * 10**26 // (21 * 10**26)
