import math
import random

from riskloom.llm.quality import STRENGTH, classify, host_and_path, judged, keep_accepted
from pyspark.sql import functions as F

COMMON = [a + b for a in "ba ko mi tu le ra".split() for b in "nd st ver ing o a".split()]


def text(rng, toxic, low):
    out = [rng.choice(COMMON) for _ in range(rng.randint(30, 120))]
    if toxic:
        out += rng.sample(["vilefool", "nastyword", "trashtalk"], 2)
    rng.shuffle(out)
    return " ".join(w + "%%%" for w in out) if low else " ".join(out)


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        toxic, low = rng.random() < 0.15, rng.random() < 0.15
        rows.append((i, text(rng, toxic, low), f"https://h{rng.randint(0, 4)}.org/{rng.choice('ab')}/x" if i % 3 else f"src{i % 5}", "en", int(not low), int(toxic)))
    return rows


DOCS, LABELS = "doc_id long, text string, source string, lang string, p_low int", "doc_id long, quality int, toxic int"


def test_rejects_and_keeps(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r[:4], 0) for r in rows], DOCS)
    labels = spark.createDataFrame([(r[0], r[4], r[5]) for r in rows if r[0] % 5 < 3], LABELS)
    found = {r.doc_id: r for r in classify(docs, labels).collect()}
    wrong = [i for i, _, _, _, good, toxic in rows if found[i].accepted != (good == 1 and toxic == 0)]
    assert len(found) == len(rows) and len(wrong) <= 3
    assert all(0 < r.path_rate_toxic < 0.5 and r.p_toxic != r.p_low for r in found.values())
    kept = keep_accepted(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in found.items() if r.accepted)
    # a bounded sample is a sample of labels, not of documents
    assert classify(docs, labels, sample=50).count() == len(rows)


def test_sparse_sites_lean_on_the_host(spark):
    from riskloom.llm.quality import site_rates

    rows = [(h * 100 + p, f"h{h}", f"p{p}", 1.0 if h == 0 else 0.05, 0.0) for h in range(6) for p in range(3) for _ in range(50 if p else 1)]
    scored = spark.createDataFrame([(s, h, p, a, b) for s, h, p, a, b in rows], "site long, host string, path string, low double, toxic double")
    rates = {r.site: r for r in site_rates(scored).collect()}
    assert rates[0].path_rate_low > 0.7 and rates[100].path_rate_low < 0.3
    assert rates[0].host_rate_low > rates[100].host_rate_low and len(rates) == 18


def test_edges(spark):
    rows = corpus(200)
    odd = [(None, None, None, None), (7, None, "x", None), (7, "", "", ""), (900, "vilefool " * 200_000, None, "en"), (901, "🎉\n" * 1000, "http://[bad", "xx"), (901, "🎉\n" * 1000, "http://[bad", "xx")]
    docs = spark.createDataFrame([(*r[:4], 0) for r in rows] + [(*r, 1) for r in odd], DOCS)
    labels = spark.createDataFrame([(r[0], r[4], r[5]) for r in rows] + [(None, 1, 0), (5, None, None), (5, 7, 3), (12345, 0, 1), (6, 0, 1), (6, 1, 0)], LABELS)
    assert classify(docs, labels).count() == docs.count()
    none = classify(docs, labels.limit(0))
    assert none.filter("accepted").count() == docs.count()
    assert classify(docs.limit(0), labels).count() == 0 and keep_accepted(docs.limit(0), labels).count() == 0
    assert keep_accepted(docs, labels.limit(0)).count() == docs.count()


def test_sites(spark):
    rows = [("https://u@Big.Org:80/News/1?x", "en"), ("http://a.b", "de"), ("src0", "fr"), (None, None)]
    df = spark.createDataFrame(rows, "s string, l string")
    got = [tuple(r) for r in df.select(*host_and_path(F.col("s"), F.col("l"))).collect()]
    assert got == [("big.org", "/News"), ("a.b", ""), ("src0", "fr"), ("", "")]


def plain_posteriors(rows):
    """Rates of (host, path) for each row of (host, path, expectation), by dictionaries: global, then host, then path."""
    def level(groups):
        # groups: key -> (rows, sum, centre); strength by moments over all groups
        n = sum(g[0] for g in groups.values())
        within = max(sum(r * c * (1 - c) for r, _, c in groups.values()) / n, 1e-12)
        between = max(sum(r * (s / r - c) ** 2 for r, s, c in groups.values()) / n - within * len(groups) / n, 1e-12)
        strength = min(max(within / between - 1, STRENGTH[0]), STRENGTH[1])
        return {k: (s + strength * c) / (r + strength) for k, (r, s, c) in groups.items()}

    def grouped(key):
        sums = {}
        for row in rows:
            n, s = sums.get(key(row), (0, 0.0))
            sums[key(row)] = n + 1, s + row[2]
        return sums

    whole = sum(r[2] for r in rows) / len(rows)
    hosts = level({h: (n, s, whole) for h, (n, s) in grouped(lambda r: r[0]).items()})
    paths = level({k: (n, s, hosts[k[0]]) for k, (n, s) in grouped(lambda r: r[:2]).items()})
    return hosts, paths


def posteriors_agree(found):
    for q in ("low", "toxic"):
        hosts, paths = plain_posteriors([(r["host"], r["path"], r[q]) for r in found])
        for r in found:
            rate = paths[r["host"], r["path"]]
            assert math.isclose(r[f"host_rate_{q}"], hosts[r["host"]], rel_tol=1e-9)
            assert math.isclose(r[f"path_rate_{q}"], rate, rel_tol=1e-9)
            odds = r[f"own_{q}"] + math.log(rate / (1 - rate))
            assert math.isclose(r[f"p_{q}"], 1 / (1 + math.exp(-odds)), rel_tol=1e-9)
    assert all(r["accepted"] == (r["p_low"] <= 0.5 and r["p_toxic"] <= 0.5) for r in found)


def test_posteriors_of_the_whole_table(spark, tiny):
    docs, labels = (spark.read.parquet(f"{tiny}/{t}.parquet") for t in ("documents", "labels"))
    found = judged(docs, labels).collect()
    assert len(found) == docs.count()
    posteriors_agree(found)


def test_posteriors_of_sparse_and_uneven_sites(spark):
    rows = corpus(400, seed=3)
    docs = spark.createDataFrame([(i, t, f"https://h{i % 2 if i < 300 else i}.org/{i % 7}/x", "en", 0) for i, t, *_ in rows], DOCS)
    labels = spark.createDataFrame([(r[0], r[4], r[5]) for r in rows if r[0] % 2], LABELS)
    posteriors_agree(judged(docs, labels).collect())
