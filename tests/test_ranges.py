"""Order statistics, running totals and KS against brute force, on one path for all sizes."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.functions.ranges import balanced_cuts, column_profile, order_statistics, quantiles, running_totals
from riskloom.operators import drift

LEVELS = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    n = 4000
    data = pd.DataFrame({
        "normal": rng.normal(0, 1, n), "heavy": np.exp(rng.normal(0, 6, n)), "ties": rng.integers(0, 7, n).astype(float),
        "hot": np.where(rng.random(n) < 0.4, 5.0, rng.normal(5, 3, n)), "flat": 2.0, "whole": rng.integers(-9, 9, n),
    })
    data.loc[rng.random(n) < 0.2, "normal"] = None
    return data, spark.createDataFrame(data).repartition(5)


def test_quantiles_equal_numpy(frame):
    data, df = frame
    from riskloom.functions.columns import nan_to_null

    found = quantiles(nan_to_null(df), {c: LEVELS for c in data.columns})
    for c in data.columns:
        np.testing.assert_allclose(found[c], np.quantile(data[c].dropna(), LEVELS), rtol=1e-12, atol=1e-12)


def test_empty_column_has_no_quantile(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert quantiles(df, {"x": [0.5]}) == {"x": [None]}


def test_nan_and_infinity_are_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (3.0,), (-float("inf"),)], "x double")
    assert column_profile(df, ["x"])["x"]["n"] == 2
    assert column_profile(df, ["x"])["x"]["missing"] == 1
    assert quantiles(df, {"x": [0.5]})["x"] == [2.0]


def test_cuts_are_increasing_and_balanced(frame):
    data, df = frame
    cuts = balanced_cuts(df, {"heavy": 10, "hot": 10, "flat": 10})
    for c, points in cuts.items():
        assert points == sorted(set(points))
    sizes = np.diff(np.r_[0, np.searchsorted(np.sort(data["heavy"]), cuts["heavy"]), len(data)])
    assert sizes.max() < 2 * len(data) / 10


def test_a_poor_sketch_is_found_out(frame, monkeypatch):
    """Brackets around the wrong place: the running count misses the ranks and wider brackets are tried."""
    from riskloom.functions import ranges

    data, df = frame
    real = ranges.sketched
    monkeypatch.setattr(ranges, "sketched", lambda d, f, *a: real(d, {c: [min(p + 0.01, 1.0) for p in ps] for c, ps in f.items()}, *a))
    profile = column_profile(df, ["heavy", "hot"])
    ranks = {c: [0, 7, 1999, 2000, 3999] for c in profile}
    found = order_statistics(df, ranks, profile)
    for c in ranks:
        assert [found[c][k] for k in ranks[c]] == np.sort(data[c])[ranks[c]].tolist()


def test_running_totals_match_cumulative_sums(frame):
    data, df = frame
    out = running_totals(df, "hot", {"n": F.lit(1).cast("long"), "w": F.col("whole").cast("long")}, descending=True).orderBy(
        F.desc("value")).toPandas()
    want = data.groupby("hot").agg(n=("hot", "size"), w=("whole", "sum")).sort_index(ascending=False).cumsum()
    assert out["cum_n"].tolist() == want["n"].tolist()
    assert out["cum_w"].tolist() == want["w"].tolist()
    assert set(out["all_n"]) == {len(data)}


def brute_ks(a, b):
    v = np.unique(np.concatenate([a, b]))
    return np.max(np.abs(np.searchsorted(np.sort(a), v, side="right") / len(a)
                         - np.searchsorted(np.sort(b), v, side="right") / len(b)))


def test_ks_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    a = pd.DataFrame({"same": rng.normal(0, 1, 1500), "moved": rng.normal(0, 1, 1500), "ties": rng.integers(0, 5, 1500) * 1.0})
    b = pd.DataFrame({"same": rng.normal(0, 1, 1100), "moved": rng.normal(0.7, 1, 1100), "ties": rng.integers(0, 6, 1100) * 1.0})
    found = drift.ks_statistics(spark.createDataFrame(a), spark.createDataFrame(b), list(a.columns))
    for c in a.columns:
        assert found[c] == pytest.approx(brute_ks(a[c].to_numpy(), b[c].to_numpy()), abs=1e-12)


def test_ordered_work_never_meets_in_one_partition(frame):
    _, df = frame
    plan = running_totals(df, "heavy", {"n": F.lit(1).cast("long")})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    # the only unpartitioned step orders the totals of the ranges, not the rows
    assert text.count("Exchange SinglePartition") <= 2
    assert "hashpartitioning(value_at" in text


def test_no_task_orders_more_than_the_bound(frame, monkeypatch):
    """100 copies of every row and distinct noise: three levels of brackets, none of which is ordered beyond the bound."""
    from riskloom.functions import ranges

    data, _ = frame
    spark = frame[1].sparkSession
    base = spark.createDataFrame(data[["heavy", "ties", "hot"]])
    df = base.crossJoin(spark.range(100)).withColumn("noisy", F.col("heavy") + F.col("id") * 1e-7).repartition(8)
    seen, rounds = [], []
    real, narrow = ranges.values_inside, ranges._narrow

    def watched(d, intervals):
        counted = real(d, intervals)
        seen.append(counted.filter("x IS NOT NULL").groupBy("c", "j").count().agg(F.max("count")).first()[0] or 0)
        return counted

    monkeypatch.setattr(ranges, "values_inside", watched)
    monkeypatch.setattr(ranges, "_narrow", lambda *a: rounds.append(1) or narrow(*a))
    monkeypatch.setattr(ranges, "SPREAD", 0.02)
    monkeypatch.setattr(ranges, "ACCURACY", 100)
    profile = column_profile(df, ["heavy", "ties", "hot", "noisy"])
    ranks = {c: [0, 1, 123_456, 199_999, 200_000, 399_999] for c in profile}
    found = order_statistics(df, ranks, profile, ordered_rows=300)
    whole = df.select("heavy", "ties", "hot", "noisy").toPandas()
    for c in ranks:
        assert [found[c][k] for k in ranks[c]] == np.sort(whole[c])[ranks[c]].tolist()
    assert max(seen) <= 300 and len(rounds) >= 2


def test_ks_splits_open_ranges_again(spark, monkeypatch):
    """Equal distributions leave most ranges open; with a low bound they are cut over three levels."""
    from riskloom.functions import ranges

    rng = np.random.default_rng(8)
    draw = lambda n: pd.DataFrame({"same": rng.normal(0, 1, n), "ties": rng.integers(0, 40, n) * 1.0,
                                   "hot": np.where(rng.random(n) < 0.5, 3.0, rng.normal(3, 1, n))})
    a, b = draw(40_000), draw(30_000)
    levels = []
    real = ranges.local_rows
    monkeypatch.setattr(ranges, "local_rows", lambda s, rows, schema: levels.append(len(rows)) or real(s, rows, schema)
                        if "node int, cuts" in str(schema) else real(s, rows, schema))
    monkeypatch.setattr(ranges, "CHILDREN", 4)
    monkeypatch.setattr(ranges, "SPAN", 16)
    both = drift.two_sided(spark.createDataFrame(a), spark.createDataFrame(b), list(a.columns))
    profile = {c: {"n": 70_000} for c in a.columns}
    found = ranges.largest_gaps(both, list(a.columns), "side", profile, ordered_rows=40)
    for c in a.columns:
        assert found[c] == pytest.approx(brute_ks(a[c].to_numpy(), b[c].to_numpy()), abs=1e-12)
    assert len(levels) >= 3


def test_ranges_are_balanced_for_each_key(spark, monkeypatch):
    """Keys with disjoint values, one with a hot value: no range of a key has more different values than the bound."""
    from riskloom.functions import ranges

    rng = np.random.default_rng(4)
    data = pd.concat([pd.DataFrame({"m": f"m{k}", "p": k / 1000 + rng.random(n) / 1000}) for k, n in enumerate((9000, 500, 3000))]
                     + [pd.DataFrame({"m": "m3", "p": np.where(rng.random(4000) < 0.7, 0.5, rng.random(4000))})])
    df = spark.createDataFrame(data).repartition(4)
    monkeypatch.setattr(ranges, "ACCURACY", 50)
    out = running_totals(df, "p", {"n": F.lit(1).cast("long")}, ["m"], rows_per_range=100).toPandas().sort_values(["m", "value"])
    for m, own in data.groupby("m"):
        want = own.groupby("p").size().cumsum()
        got = out[out["m"] == m]
        assert got["cum_n"].tolist() == want.tolist() and set(got["all_n"]) == {len(own)}
    cuts = ranges.range_cuts(df, "p", ["m"], 100)
    at = np.searchsorted(cuts, data["p"], side="right")
    assert data.assign(at=at).groupby(["m", "at"])["p"].nunique().max() <= 100
