"""Splits, folds, samples, drift injection and fitted preprocessing."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from riskloom.operators import sampling
from riskloom.operators.preprocess import TabularPreprocessor, TabularPreprocessorModel
from riskloom.session import shared_folder


@pytest.fixture(scope="module")
def people(spark):
    return spark.range(10_000).select(F.col("id"), (F.col("id") % 12 == 0).cast("int").alias("y"),
                                      (F.col("id") % 7).cast("double").alias("x")).repartition(6)


def sizes(df, column):
    return {r[column]: r["count"] for r in df.groupBy(column).count().collect()}


def test_hash_split_is_reproducible_and_near_its_shares(people):
    a, b = sampling.split_by_hash(people, "id"), sampling.split_by_hash(people.repartition(3), "id")
    assert a.join(b, ["id", "split"]).count() == 10_000
    n = sizes(a, "split")
    assert abs(n["test"] - 1500) < 150 and abs(n["validation"] - 1500) < 150
    other = sampling.split_by_hash(people, "id", seed=7)
    assert a.join(other, ["id", "split"]).count() < 8000


def test_exact_split_is_stratified_disjoint_and_complete(people):
    out = sampling.split_exact(people, "id", "y")
    assert sizes(out, "split") == {"test": 1500, "validation": 1500, "train": 7000}
    positives = sizes(out.filter("y = 1"), "split")
    assert positives == {"test": 125, "validation": 125, "train": 584}
    again = sampling.split_exact(people.repartition(2), "id", "y")
    assert out.join(again, ["id", "split"]).count() == 10_000


@pytest.mark.parametrize("shares", [(0.0, 0.1), (0.1, 1.0), (0.5, 0.5)])
def test_split_shares_are_checked(people, shares):
    with pytest.raises(ValueError):
        sampling.split_exact(people, "id", "y", *shares)
    with pytest.raises(ValueError):
        sampling.split_by_hash(people, "id", *shares)


def test_empty_table_cannot_be_split(people):
    with pytest.raises(ValueError, match="empty"):
        sampling.split_exact(people.filter("false"), "id", "y")


def test_folds_are_balanced_per_class(people):
    out = sampling.stratified_folds(people, "id", "y", 3)
    for label in (0, 1):
        n = sizes(out.filter(F.col("y") == label), "fold")
        assert len(n) == 3 and max(n.values()) - min(n.values()) <= 1


def test_samples_have_the_size_asked_for(people):
    one = sampling.sample_rows(people, "id", 321, 5)
    assert one.count() == 321 and one.select("id").distinct().count() == 321
    assert sampling.sample_rows(people, "id", 10 ** 6, 5).count() == 10_000
    assert sampling.sample_rows(people, "id", 321, 6).join(one, "id").count() < 100


def test_samples_of_repeated_keys_have_the_size_asked_for(spark):
    df = spark.createDataFrame([(i % 2, i // 4) for i in range(10)], "k int, v int")
    for n in range(12):
        assert sampling.sample_rows(df, "k", n).count() == min(n, 10)


def test_more_cuts_than_are_broadcast(spark, people, monkeypatch):
    strata = people.withColumn("s", F.col("id") % 1500)
    want = {r["id"]: r["fold"] for r in sampling.stratified_folds(strata, "id", "s", 3).select("id", "fold").collect()}
    monkeypatch.setattr(sampling, "BROADCAST_CUTS", 10)
    assert {r["id"]: r["fold"] for r in sampling.stratified_folds(strata, "id", "s", 3).select("id", "fold").collect()} == want


def test_drift_injection(spark):
    df = spark.range(5000).select("id", (F.col("id") % 10).cast("double").alias("a"), (F.col("id") % 9).cast("double").alias("b"),
                                  F.when(F.col("id") % 3 == 0, "p").otherwise("q").alias("c"))
    plan = sampling.DriftPlan(scale={"a": 2.0}, shift={"b": 1.0, "gone": 1.0}, category="c", blank="a")
    out, applied = sampling.inject_drift(df, "id", plan)
    assert applied == ["a", "b", "c", "a (missing rate)"]
    row = out.agg(F.avg("a"), F.avg("b"), F.avg((F.col("c") == "q").cast("int")), F.avg(F.col("a").isNull().cast("int"))).first()
    assert row[0] == pytest.approx(9.0, abs=0.2) and row[1] == pytest.approx(4 + np.std(np.arange(9)), abs=0.01)
    assert row[2] == pytest.approx(2 / 3 + 0.05, abs=0.02) and row[3] == pytest.approx(0.12, abs=0.02)
    assert sampling.class_balance(df.withColumn("y", (F.col("id") < 1000).cast("int")), "y").first()["scale_pos_weight"] == 4.0


@pytest.fixture(scope="module")
def train(spark):
    rows = [(1.0, 2.0, "a"), (2.0, None, "b"), (3.0, 4.0, "b"), (4.0, 6.0, None), (100.0, None, "a")]
    return spark.createDataFrame(rows, "n1 double, n2 double, c string")


def test_preprocessor_matches_numpy(spark):
    rng = np.random.default_rng(1)
    n1 = np.where(rng.random(400) < 0.3, np.nan, rng.normal(5, 2, 400))
    n2 = np.exp(rng.normal(0, 2, 400))
    data = pd.DataFrame({"n1": n1, "n2": n2})
    df = spark.createDataFrame([(None if np.isnan(a) else float(a), float(b)) for a, b in zip(n1, n2)], "n1 double, n2 double")
    model = TabularPreprocessor(inputCols=["n1", "n2"]).fit(df)
    got = model.transform_columns(df).toPandas()
    for c in ("n1", "n2"):
        x = data[c].fillna(np.nanmedian(data[c])).to_numpy()
        q1, q3 = np.percentile(x, [25, 75])
        x = np.clip(x, q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
        np.testing.assert_allclose(got[c], (x - x.mean()) / x.std(), atol=1e-9)


def test_transform_uses_only_what_was_fitted(spark, train):
    model = TabularPreprocessor(inputCols=["n1", "n2", "c"]).fit(train)
    assert model.output_names() == ["n1", "n2", "c_a", "c_b"]
    assert model.feature_types() == (["n1", "n2"], ["c"])
    later = spark.createDataFrame([(1e9, None, "unseen"), (None, None, None)], "n1 double, n2 double, c string")
    a, b = model.transform_columns(later).collect()
    assert (a["c_a"], a["c_b"]) == (0.0, 0.0) and (b["c_a"], b["c_b"]) == (1.0, 0.0)
    assert a["n1"] < 10 and a["n2"] == b["n2"]


def test_constant_and_void_columns(spark):
    df = spark.createDataFrame([(3.0, None), (3.0, None)], "flat double, void double")
    model = TabularPreprocessor(inputCols=["flat", "void"]).fit(df)
    assert model.output_names() == ["flat"]
    assert [r["flat"] for r in model.transform_columns(df).collect()] == [0.0, 0.0]


def test_saved_pipeline_transforms_alike(spark, train):
    path = shared_folder(spark, "pipeline")
    fitted = Pipeline(stages=[TabularPreprocessor(inputCols=["n1", "n2", "c"], iqrFactor=2.0)]).fit(train)
    fitted.write().overwrite().save(path)
    again = PipelineModel.load(path)
    assert isinstance(again.stages[0], TabularPreprocessorModel)
    assert again.transform(train).select("features").collect() == fitted.transform(train).select("features").collect()


def test_many_levels_make_a_sparse_vector(spark):
    df = spark.range(12_000).select(F.col("id").cast("string").alias("c"), F.col("id").cast("double").alias("x"))
    model = TabularPreprocessor(inputCols=["x", "c"]).fit(df)
    assert len(model.output_names()) == 12_001
    rows = model.transform(df.limit(50)).collect()
    names = model.output_names()
    for r in rows:
        assert r["features"].size == 12_001 and names[int(r["features"].indices[-1])] == f"c_{r['c']}"
    unseen = model.transform(spark.createDataFrame([("new", 5.0)], "c string, x double")).first()["features"]
    assert set(unseen.toArray()[1:]) == {0.0}


def test_quotes_in_categories_and_names(spark):
    df = spark.createDataFrame([("it's", 1.0), ("a\\b", 2.0)], "`odd name` string, `x.y` double")
    model = TabularPreprocessor(inputCols=["odd name", "x.y"]).fit(df)
    out = model.transform(df).select("features").collect()
    assert sorted(tuple(r[0].toArray()[1:]) for r in out) == [(0.0, 1.0), (1.0, 0.0)]
