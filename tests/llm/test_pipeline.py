"""Each stage on what its predecessor kept, against a plain version of the stage."""

import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from riskloom.llm.common import stored, table
from riskloom.llm.packing import default_tokenizer
from riskloom.llm.quality import classify

from test_decontaminate import brute as contaminated
from test_line_dedup import brute as lines
from test_simhash import brute as near


def test_stages_one_by_one(spark, tiny):
    docs = table(spark, tiny, "documents")
    kept = {r.doc_id: r for r in docs.collect()}
    items = [tuple(r) for r in table(spark, tiny, "benchmark").select("item_id", "text").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, tiny), name)
        assert out.schema.simpleString() == docs.schema.simpleString()
        rows = [(i, r.text) for i, r in sorted(kept.items())]
        if name == "quality_classifier":
            want = {r.doc_id: kept[r.doc_id].text for r in classify(docs, table(spark, tiny, "labels")).filter("accepted").collect()}
        elif name == "line_dedup":
            want = {i: text for i, text, _, _ in lines(rows)}
        elif name == "simhash_near_dedup":
            want = {i: kept[i].text for i, _, low in near(rows) if i == low}
        else:
            want = {i: kept[i].text for i, _, hit, _ in contaminated(rows, items) if not hit}
        now = {r.doc_id: r for r in out.collect()}
        assert {i: r.text for i, r in now.items()} == want, name
        assert all((r.lang, r.source, r.n_chars) == (kept[i].lang, kept[i].source, kept[i].n_chars) for i, r in now.items())
        docs, kept = out, now
    whole, found = Tokenizer.from_file(default_tokenizer()), {}
    for r in corpus_pipeline.STAGES[-1][1](spark, docs, tiny).collect():
        found[r.doc_id, r.piece] = (r.length, r.ids_crc32)
    for i, r in kept.items():
        ids = np.array(whole.encode(r.text, add_special_tokens=False).ids + [1], "<u4")
        for n, s in enumerate(range(0, len(ids), 4096)):
            assert found.pop((i, n)) == (len(p := ids[s : s + 4096]), zlib.crc32(p.tobytes()))
    assert not found


def test_run_and_empty(spark, tiny):
    assert corpus_pipeline.run(spark, tiny).count() > 0
    empty = table(spark, tiny, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, tiny).count() == 0


def test_columns_of_any_name_come_back(spark, tiny):
    docs = table(spark, tiny, "documents").limit(60)
    names = ["__id", "__mark", "__lost", "id", "mark", "row", "_ROW", "lost", "_id", "body", "component"]
    wide = docs.select("*", *[(docs.doc_id + n).alias(name) for n, name in enumerate(names)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        want = {r.doc_id for r in stage(spark, docs, tiny).collect()}
        out = stage(spark, wide, tiny)
        assert out.columns == wide.columns, name
        rows = out.collect()
        assert {r.doc_id for r in rows} == want, name
        assert all(r[name] == r.doc_id + n for r in rows for n, name in enumerate(names))
