import re

import pytest

from riskloom.llm import decontaminate
from riskloom.llm.common import id_and_text
from riskloom.llm.decontaminate import contamination, drop_contaminated, matches, pack, unpack


def plain_words(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items):
    windows = set()
    for i, t in items:
        w = plain_words(t)
        for s in range(max(1, len(w) - 9) if w else 0):
            windows.add((i, tuple(w[s : s + 10])))
    out = []
    for d, t in docs:
        w, hit, found = plain_words(t), set(), set()
        for i, k in windows:
            for s in range(len(w) - len(k) + 1):
                if tuple(w[s : s + len(k)]) == k:
                    hit |= set(range(s, s + len(k)))
                    found.add(i)
        out.append((d, len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=repr)


LONG = " ".join(f"w{i}" for i in range(25))
ITEMS = [(1, LONG), (2, "Hello, wörld!"), (10, "hello wörld"), (3, None), (4, ""), (5, " -- "), (1, LONG), (None, "lonely null item")]
DOCS = [(1, "x " * 70 + LONG + " tail"), (2, "HELLO---Wörld hello wörld w0 w1"), (3, None), (4, ""), (None, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9"),
        (2, "w0 w1 w2 w3 w4 w5 w6 w7 w8"), (5, "a lonely null item here"), (6, ("w0 " * 3000) + " ".join(f"w{i}" for i in range(12)) + " w0" * 90_000),
        (7, " ".join(f"w{i}" for i in range(5))), (8, " ".join(f"w{i}" for i in range(5, 12))), (9, "WÖRLD Wörld")]


@pytest.mark.parametrize("shard, cut", [(2_000_000, 2_000_000), (40, 30)])
def test_phrases(spark, monkeypatch, shard, cut):
    monkeypatch.setattr(decontaminate.item_slices, "__defaults__", (cut,))
    docs = spark.createDataFrame([(i, t, 7) for i, t in DOCS], "doc_id long, text string, n_hit int").coalesce(2)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in contamination(docs, items).collect()]
    assert sorted(got, key=repr) == brute(DOCS, ITEMS)
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    clean = [d for d in DOCS if not brute([d], ITEMS)[0][2]]
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=repr) == sorted(clean, key=repr)


def test_empty(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs, none).filter("contaminated").count() == 0
    assert contamination(docs.limit(0), spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "c x x b x a"), (2, "a " + "x " * 20 + "b c"), (3, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    rows, found = matches(id_and_text(docs, "doc_id", "text"), items, within=5)
    assert [r.id for r in rows.join(found.select("row").distinct(), "row").collect()] == [1]
    with pytest.raises(ValueError):
        matches(id_and_text(docs, "doc_id", "text"), items, within=1000)


def test_packing_lists():
    import numpy as np

    for gaps in ([0], [0, 1, 255, 256], [5, 70_000, 1], [2**33]):
        at = np.cumsum(np.array(gaps))
        assert (unpack(pack(at)) == at).all()


def test_rows_keep_their_number_between_slices(spark, monkeypatch):
    """The stored documents are read in other splits for each slice, as after a change of the session's cores."""
    monkeypatch.setattr(decontaminate.item_slices, "__defaults__", (3,))
    build, sizes = decontaminate.build_index, iter(["128m", "1k", "64m", "2k"] * 50)
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def built(docs, vocabulary):
        spark.conf.set("spark.sql.files.maxPartitionBytes", next(sizes))
        return build(docs, vocabulary)

    monkeypatch.setattr(decontaminate, "build_index", built)
    rows = DOCS + [(i, f"filler {i} " * 400) for i in range(100, 140)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    try:
        found = contamination(docs, spark.createDataFrame(ITEMS, "item_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found), key=repr) == brute(rows, ITEMS)
