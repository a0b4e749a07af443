import hashlib

import numpy as np
import pyarrow as pa

from riskloom.llm import line_dedup
from riskloom.llm.common import id_and_text
from riskloom.llm.line_dedup import dedup_lines, kept_lines, lines_to_drop

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def key(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(SPACE))


def brute(rows):
    last = 2**63 - 1
    where = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            where.setdefault(key(x), set()).add(last if i is None else i)
    out = []
    for i, t in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if len(key(x)) < 10 or len(where[key(x)]) < 2 or min(where[key(x)]) == (last if i is None else i)]
        out.append((i, "\n".join(kept), len(own), len(own) - len(kept)))
    return out


def same(found, rows):
    got = [(r.doc_id, r.kept_text, r.n_lines, r.n_dropped, r.kept_sha256) for r in found.collect()]
    assert sorted(got, key=repr) == sorted([(*r, hashlib.sha256(r[1].encode()).hexdigest()) for r in brute(rows)], key=repr)


ROWS = [(1, "a long enough line\nshort\n\n"), (2, " A LONG enough line\x0b\nshort\nnine char\nten chars!"), (3, None), (4, ""), (5, "ten chars!\nten chars!\nÄÖÜ long enough"),
        (6, "äöü long enough\nÄÖÜ Long enough"), (6, "a long enough line\nonly here, twice\nonly here, twice"), (6, "only here, twice"), (None, "ten chars!"), (None, "without an id"),
        (None, "without an id"), (9, "ééééééééé\nééééééééé!"), (10, "ééééééééé\nééééééééé!"), (11, "x\n" * 200_000 + "a long enough line\r\n" * 1000), (12, "y" * 1_000_000), (13, "Y" * 1_000_000)]


def test_edges(spark):
    docs = spark.createDataFrame([(i, t, 5, "k") for i, t in ROWS], "doc_id long, text string, n_lines int, line string").repartition(4)
    same(kept_lines(docs), ROWS)
    out = dedup_lines(docs)
    assert out.columns == docs.columns
    want = sorted([(i, None if t is None else left[1]) for (i, t), left in zip(ROWS, brute(ROWS))], key=repr)
    assert sorted([(r.doc_id, r.text) for r in out.collect()], key=repr) == want
    assert kept_lines(docs.limit(0)).count() == 0 and dedup_lines(docs.limit(0)).count() == 0


def test_slices(spark, tiny):
    docs = id_and_text(spark.read.parquet(f"{tiny}/documents.parquet"), "doc_id", "text")
    lost = lambda n: {(r.id, x) for r in lines_to_drop(docs, n).collect() for x in map(bytes, r.lost)}
    assert lost(300) == lost(10**9) and lost(300)
    lines = docs.selectExpr("sum(size(split(body, '\\n')))").first()[0]
    assert lost(-(-lines // 20)) == lost(300)  # twenty slices


def test_hot_lines(spark):
    rows = [(i, f"the line that is everywhere\nunique line number {i}\nshared by few {i // 3}") for i in range(3000)]
    same(kept_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)), rows)


def test_filter_has_no_false_negative():
    lines = [hashlib.md5(str(k).encode()).digest() for k in range(2000)]
    size = line_dedup.CHUNK
    batch = lambda own, n: pa.RecordBatch.from_pydict({"line": pa.array(own, pa.binary()), "slice": pa.array([n] * len(own), pa.int32())})
    once = [batch(own, 3) for own in (lines, lines[:700], lines[650:900])] + [batch(lines[:50], 2)]
    marks = pa.Table.from_batches(line_dedup._marks(size)(iter(once)))
    assert marks.column("slice").to_pylist() == [2, 3]
    twice = line_dedup._merge((pa.scalar(3), pa.scalar(0)), marks.slice(1)).column("twice")[0].as_py()
    rows = batch(lines, 3).append_column("id", pa.array(range(2000))).append_column("mark", pa.array(range(2000)))
    hit = {i for b in line_dedup._suspects(lambda n: np.frombuffer(twice, np.uint8), size)([rows]) for i in b.column("id").to_pylist()}
    assert hit >= set(range(900)) and len(hit) < 1500


def test_many_rows_without_an_id(spark):
    """What a row loses is gathered for its own text, never for all rows of an id."""
    rows = [(1, "the line that is everywhere")] + [(None if n % 2 else 7, f"the line that is everywhere\nline of a pair {n // 2}\nown line {n}") for n in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    same(kept_lines(docs), rows)
    assert lines_to_drop(id_and_text(docs, "doc_id", "text")).selectExpr("max(size(lost))").first()[0] == 2
