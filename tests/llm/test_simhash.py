import collections

import xxhash
from pyspark.sql import functions as F

from riskloom.llm.simhash import components, drop_near_duplicates, fingerprint, near_duplicates


def plain(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    words = [w.decode() for w in words]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [plain(t) for _, t in rows]
    label = [i for i, _ in rows]
    changed = True
    by = collections.defaultdict(list)
    for n, p in enumerate(prints):
        by[p].append(n)
    distinct = list(by)
    low = {p: min(label[n] for n in by[p]) for p in distinct}
    near = [(p, q) for k, p in enumerate(distinct) for q in distinct[:k] if (p ^ q).bit_count() <= 2]
    while changed:
        changed = False
        for p, q in near:
            if low[p] != low[q]:
                low[p] = low[q] = min(low[p], low[q])
                changed = True
    return {(i, f"{p:016x}", low[p]) for (i, _), p in zip(rows, prints)}


def test_whole_small_table(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    got = {tuple(r) for r in near_duplicates(docs).collect()}
    assert got == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_edges(spark):
    rows = [(5, None), (3, ""), (9, " \t\n"), (7, "One two"), (2, "one  TWO"), (7, "One two"), (11, "Ä b c d " * 70_000), (4, "Ä B C D " * 70_000)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, print int, component string")
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == brute(rows)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    assert near_duplicates(docs.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, "a b c d"), (1, "a b c d"), (None, "q r s t u")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in near_duplicates(nulls).collect()} == {(None, 1), (1, 1), (None, None)}
    assert fingerprint(b"") == 0


def test_lists_cut_into_blocks(spark):
    """A chain of fingerprints two bits apart in one list, with a block of four."""
    prints = [0]
    for i in range(40):
        prints.append(prints[-1] ^ (1 << i % 16) ^ (1 << (i * 7 + 3) % 16))
    rows = spark.createDataFrame([(n + 100, p, 0) for n, p in enumerate(dict.fromkeys(prints))], "id long, print long, mark long")
    assert {r.component for r in components(rows, 2, 4).collect()} == {100}
    far = rows.withColumn("print", F.shiftleft("print", 48) + F.shiftleft("print", 32))
    assert components(far, 0, 4).select("component").distinct().count() == rows.count()

