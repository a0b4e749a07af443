import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from riskloom.llm.packing import LENGTH, default_tokenizer, pack, pack_documents, word_ids

POOL = [*" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0  　​﻿̸́̈aAbé1½9ßÀÿ×÷'stT!.,<|>$\x00한中İΣ",
        "<|startoftext|>", "<|endoftext|>", "'s", "I'll", "Élan!!", "mañana,", "THE", "é"]


def test_ids_are_the_tokenizers():
    whole, quick = Tokenizer.from_file(default_tokenizer()), word_ids(default_tokenizer())
    rng = random.Random(5)
    for _ in range(8000):
        text = "".join(rng.choice(POOL) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(quick(text.encode()), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def check(docs, rows):
    whole = Tokenizer.from_file(default_tokenizer())
    want = []
    for i, t in docs:
        ids = np.array(whole.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want += [(i, n, s, len(p := ids[s : s + LENGTH]), zlib.crc32(p.tobytes())) for n, s in enumerate(range(0, len(ids), LENGTH))]
    assert sorted((tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in rows), key=repr) == sorted(want, key=repr)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= LENGTH
    return len(by), -(-sum(r.length for r in rows) // LENGTH)


def test_whole_small_table(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    used, least = check([tuple(r) for r in docs.select("doc_id", "text").collect()], pack_documents(docs).collect())
    assert used <= least * 1.01 + 1


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (1, "the " * 4095), (3, "the " * 4096), (4, "the " * 20_000), (4, "the " * 20_000)]
    docs = spark.createDataFrame([(i, t, 3) for i, t in rows], "doc_id long, text string, length int")
    check(rows, pack_documents(docs, group=3).collect())
    ids = pack_documents(docs, with_ids=True).filter("doc_id = 2").first()
    assert list(ids["ids"]) == [1]
    assert pack_documents(docs.limit(0)).count() == 0


def test_few_bins():
    lengths = np.random.default_rng(1).integers(1, 4096, 3000)
    bins = pack(lengths)
    assert sorted(p for b in bins for p in b) == list(range(3000))
    assert max(lengths[b].sum() for b in bins) <= LENGTH
    assert len(bins) <= 1.03 * lengths.sum() / LENGTH
