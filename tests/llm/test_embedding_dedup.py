import math

import numpy as np

from riskloom.llm.embedding_dedup import links, plan


def brute(rows, threshold=0.95):
    good = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    n = len(rows)
    near = [[] for _ in rows]
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if g else None for (_, v), g in zip(rows, good)]
    for i in range(n):
        for j in range(i):
            if good[i] and good[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                near[i].append(j)
                near[j].append(i)
    low = [i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in near[i]:
                if low[j] < low[i]:
                    low[i], changed = low[j], True
    return sorted((rows[i][0], len(near[i]), low[i], low[i] == rows[i][0]) for i in range(n))


def answer(df, **options):
    return sorted(tuple(r) for r in links(df, **options).collect())


def test_recall_on_the_test_table(spark, tiny):
    table = spark.read.parquet(f"{tiny}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in table.collect()])
    got = answer(table)
    assert [r[0] for r in got] == [r[0] for r in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in want)
    assert sum(g[2:] == w[2:] for g, w in zip(got, want)) >= 0.99 * len(want)


def test_edges(spark):
    v = [1.0, 2.0, 3.0, 0.5]
    rows = [(1, None), (2, []), (3, [0.0] * 4), (4, [1.0, None, 0.0, 0.0]), (5, [float("nan"), 1.0, 1.0, 1.0]), (6, [float("inf"), 0.0, 0.0, 0.0]),
            (17, v), (17, v), (12, [2 * x for x in v]), (9, [1e-200 * x for x in v]), (8, [1e200 * x for x in v]), (7, v[:3]), (20, [-x for x in v])]
    df = spark.createDataFrame([(i, x, 1, 2) for i, x in rows], "vec_id long, embedding array<double>, n_links int, component_id int")
    got = answer(df)
    want = brute([(i, x if i not in (8, 9) else v) for i, x in rows])
    assert got == want
    assert links(df.limit(0)).count() == 0
    none = spark.createDataFrame([(None, v), (3, v)], "vec_id long, embedding array<double>")
    assert {tuple(r) for r in links(none).collect()} == {(None, 1, 3, False), (3, 1, 3, True)}


def test_buckets_cut_into_blocks(spark):
    rng = np.random.default_rng(2)
    centre = rng.standard_normal(16)
    rows = [(i, (centre + 0.15 * rng.standard_normal(16)).tolist()) for i in range(150)] + [(1000 + i, rng.standard_normal(16).tolist()) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute(rows)
    got = answer(df, recall=0.99999, block=16)
    assert sum(r[1] for r in got) >= 0.999 * sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))


def test_plan_follows_the_table():
    assert plan(10**9)[0] > plan(10**6)[0] > plan(10**3)[0]
    planes, tables = plan(10**6)
    same = (1 - math.acos(0.95) / math.pi) ** planes
    assert 1 - (1 - same) ** tables >= 0.998
