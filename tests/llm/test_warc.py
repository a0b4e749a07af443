import hashlib
import io

from riskloom.llm import warc
from riskloom.session import shared_folder

BIG = "é" * 700


def brute(rows):
    out = []
    for i, _, h in rows:
        body = (h or "").encode()
        same = [j for j, _, g in rows if (g or "").encode() == body and j is not None]
        first = max(same) if len(body) >= 1000 and same else i
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "response" if first == i else "revisit", None if first == i else first))
    return sorted(out, key=repr)


def digest(found):
    return sorted(((r.row_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found.collect()), key=repr)


def test_round_trip_over_ranges(spark, tiny):
    pages = spark.read.parquet(f"{tiny}/pages.parquet")
    files = warc.write(pages, shared_folder(spark, "warc"))
    whole = {(r.page_id, r.url, r.html) for r in pages.collect()}
    for size in (1 << 30, 4096, 333):
        back = warc.read(spark, files, size).collect()
        assert len(back) == len(whole) and {(r.row_id, r.url, r.payload.decode()) for r in back} == whole


def test_revisits_and_edges(spark):
    rows = [(1, "u", BIG), (9, "v", BIG), (4, None, BIG), (4, None, BIG), (9, "v", BIG), (2, "w", "small"), (3, "w", "small"), (5, "x", None), (None, "y", ""),
            (None, "z", BIG), (6, "a b\nc", "\x1f ,\x08" * 3000), (7, "big", "x" * 3_000_000)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, row int").repartition(3)
    found = warc.archive(pages)
    assert digest(found) == brute(rows)
    assert {r.payload is None for r in found.filter("record_type = 'revisit'").collect()} == {True}
    assert warc.archive(pages.limit(0)).count() == 0


def test_false_magic_and_cut_files():
    one = warc.member(warc.header("response", 1, "u", "d", 5, 5, None), b"hello")
    noise = warc.MAGIC + b"noise" + warc.MAGIC + b"\x00" * 40
    blob = noise + one + noise * 3 + one + one[:-9]
    for size in (7, 50, len(blob)):
        got = [c for s in range(0, len(blob), size) for c in warc._Members(io.BytesIO(blob), len(blob), s, s + size)]
        assert len(got) == 2 and [p for c in got for _, p in warc.parse(c)] == [b"hello"] * 2


def test_ranges_are_read_by_many_tasks(spark, tiny):
    from pyspark.sql import functions as F

    files = warc.write(spark.read.parquet(f"{tiny}/pages.parquet"), shared_folder(spark, "warc"))
    size = max(1000, files.agg(F.sum("bytes")).first()[0] // 16)
    back = warc.read(spark, files, size).withColumn("task", F.spark_partition_id())
    assert back.select("task").distinct().count() >= 6
