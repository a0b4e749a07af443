"""Training, search, scoring, explanation and the end-to-end jobs."""

import itertools
import math
import threading
import time
from dataclasses import replace
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskloom.operators import attribution, scoring, training
from riskloom.operators.contracts import ContractViolation
from riskloom.operators.preprocess import TabularPreprocessor
from riskloom.operators.scores import ScoreProfile
from riskloom.operators.tree_attribution import ensemble_leaves, shapley_values, tree_attribution
from riskloom.plans.explain import explain_job
from riskloom.plans.monitor import monitor_job
from riskloom.plans.predict import predict_job
from riskloom.plans.prepare import prepare_job
from riskloom.plans.train import train_job
from riskloom.session import shared_folder

KEY, LABEL = "SK_ID_CURR", "TARGET"
SPACES = {"Random Forest": {"numTrees": [4, 6], "maxDepth": [3]}, "Gradient Boosting": {"maxIter": [3, 4], "maxDepth": [2]}}


@pytest.fixture(scope="module")
def signal(spark):
    rng = np.random.default_rng(11)
    n = 900
    a, b = rng.normal(0, 1, n), rng.normal(0, 1, n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(2.2 * a - 1.2)))).astype(int)
    rows = [(100001 + i, float(a[i]), None if i % 10 == 0 else float(b[i]), "xyz"[i % 3], int(y[i])) for i in range(n)]
    path = shared_folder(spark, "signal")
    spark.createDataFrame(rows, f"{KEY} long, num_a double, num_b double, cat_a string, {LABEL} int").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def trained(spark, signal):
    folder = shared_folder(spark, "champion")
    return train_job(signal, KEY, LABEL, folder, spaces=SPACES, n_iter=2, folds=2, operational_gates={"Recall": 0.2}), folder


def test_champion_beats_the_floors(trained):
    result, _ = trained
    assert result.test_metrics["ROC-AUC"] > 0.75 and result.test_metrics["Average Precision"] > 0.45
    assert result.deployment.promoted and 0 < result.deployment.optimal_threshold < 1
    assert result.leaderboard.count() == 3 and result.tuning.count() == 2
    assert result.deployment.input_feature_columns == ["num_a", "num_b", "cat_a"]


class Spy(TabularPreprocessor):
    seen: list = []

    def _fit(self, dataset):
        Spy.seen.append(dataset.count())
        return super()._fit(dataset)


def test_preprocessing_is_refitted_in_each_fold(signal):
    Spy.seen = []
    columns = ["num_a", "num_b", "cat_a"]
    base = training.tunable_models()["Gradient Boosting"]
    search = training.tune("Gradient Boosting", base, SPACES["Gradient Boosting"], signal, columns, LABEL, KEY, 2, 3,
                           preprocessor=Spy(inputCols=columns))
    assert len(Spy.seen) == 4 and Spy.seen[-1] == 900 and all(590 < n < 610 for n in Spy.seen[:3])
    assert search.best_params in ({"maxIter": 3, "maxDepth": 2}, {"maxIter": 4, "maxDepth": 2})
    assert 0.3 < search.best_score <= 1


def test_search_arguments(signal):
    with pytest.raises(ValueError, match="unknown"):
        training.tune_candidates(signal, ["num_a"], LABEL, KEY, ["Nothing"])
    model = training.tunable_models()["Random Forest"]
    settings = training.sampled_settings(model, training.SEARCH_SPACES["Random Forest"], 20, 42)
    assert len(settings) == 20 and len({tuple(sorted((p.name, v) for p, v in s.items())) for s in settings}) == 20
    assert settings == training.sampled_settings(model, training.SEARCH_SPACES["Random Forest"], 20, 42)
    assert len(training.sampled_settings(model, {"numTrees": [1, 2]}, 9, 1)) == 2
    with pytest.raises(ValueError, match="both classes"):
        training.training_frame(signal.filter(f"{LABEL} = 0"), LABEL)


def test_scoring_keeps_rows_and_ids(spark, signal, trained):
    _, folder = trained
    out = predict_job(spark, folder, signal.drop(LABEL).select("cat_a", "num_b", KEY, "num_a"), shared_folder(spark, "csv"))
    assert out.columns == [KEY, "DEFAULT_PROBABILITY", "PREDICTED_CLASS"] and out.select(KEY).distinct().count() == 900
    cut = trained[0].deployment.optimal_threshold
    assert out.filter((F.col("DEFAULT_PROBABILITY") >= cut) != (F.col("PREDICTED_CLASS") == 1)).count() == 0
    scorer = scoring.Scorer.load(spark, folder)
    with pytest.raises(ContractViolation, match="id column"):
        scorer.predict(signal.drop(KEY))
    with pytest.raises(ValueError, match="num_b"):
        scorer.predict(signal.drop("num_b"))
    unseen = signal.withColumn("cat_a", F.lit("new"))
    assert scorer.predict(unseen).filter("DEFAULT_PROBABILITY is null").count() == 0


@pytest.mark.parametrize("change, message", [
    ({"promoted": "false"}, "boolean"), ({"promoted": False}, "not promoted"), ({"optimal_threshold": float("nan")}, r"\[0, 1\]"),
    ({"optimal_threshold": True}, "number"), ({"optimal_threshold": 1.2}, r"\[0, 1\]"), ({"optimal_threshold": None}, "lacks"),
    ({"model_name": None}, "lacks")])
def test_artifacts_are_checked(change, message):
    record = {"model_name": "m", "optimal_threshold": 0.5, "promoted": True, "input_feature_columns": ["a"], **change}
    with pytest.raises(scoring.UnusableModel, match=message):
        scoring.Deployment.checked(record)
    if message == "not promoted":
        assert not scoring.Deployment.checked(record, allow_unpromoted=True).promoted


def test_requests(spark, signal, trained):
    scorer = scoring.Scorer.load(spark, trained[1])
    features = signal.drop(LABEL)
    asked = spark.createDataFrame([(100010, 1), (100002, 2)], f"{KEY} long, request_pos int")
    assert [r[KEY] for r in scoring.score_requests(scorer, asked, features).collect()] == [100010, 100002]
    with pytest.raises(scoring.UnknownRequests, match="7"):
        scoring.score_requests(scorer, asked.unionAll(spark.createDataFrame([(7, 3)], asked.schema)), features)
    with pytest.raises(ContractViolation, match="100010"):
        scoring.score_requests(scorer, asked.unionAll(asked), features)


def test_streamed_requests_match_the_batch(spark, signal, trained):
    from riskloom.streaming.requests import run_scoring

    scorer = scoring.Scorer.load(spark, trained[1])
    features, where = signal.drop(LABEL), shared_folder(spark, "stream")
    asked = spark.createDataFrame([(100005, 1), (100006, 2), (5, 3)], f"{KEY} long, request_pos int")
    asked.write.parquet(f"{where}/in")
    stream = spark.readStream.schema(asked.schema).parquet(f"{where}/in")
    query = run_scoring(scorer, stream, features, f"{where}/out", f"{where}/checkpoint")
    assert query.awaitTermination(120)
    got = {r[KEY]: r["DEFAULT_PROBABILITY"] for r in spark.read.parquet(f"{where}/out").collect()}
    want = {r[KEY]: r["DEFAULT_PROBABILITY"] for r in scorer.predict(features).collect()}
    assert got == {100005: want[100005], 100006: want[100006], 5: None}


def brute_shapley(row, leaves, width):
    def value(known):
        total = 0.0
        for v, ids, low, high, part in leaves:
            weight = 1.0
            for j, a, b, s in zip(ids, low, high, part):
                weight *= float(a < row[j] <= b) if j in known else s
            total += v * weight
        return total

    out = []
    for i in range(width):
        others = [j for j in range(width) if j != i]
        out.append(sum(math.factorial(k) * math.factorial(width - 1 - k) / math.factorial(width)
                       * (value({*s, i}) - value(set(s)))
                       for k in range(width) for s in itertools.combinations(others, k)))
    return out


@pytest.mark.parametrize("name", ["Random Forest", "Gradient Boosting"])
def test_tree_attribution_is_exact_and_additive(spark, signal, name):
    data = VectorAssembler(inputCols=["num_a", "id7", "id5"], outputCol="features").transform(
        training.training_frame(signal, LABEL).data.withColumn("id7", F.col(KEY) % 7).withColumn("id5", F.col(KEY) % 5))
    model = training.tunable_models(1)[name].setMaxDepth(4)
    model = (model.setNumTrees(3) if name == "Random Forest" else model.setMaxIter(3)).fit(data)
    made, base = tree_attribution(model.transform(data), model)
    rows = made.select("features", "attribution", "probability", "rawPrediction").limit(40).toPandas()
    out = [r[1] for r in (rows["probability"] if name == "Random Forest" else rows["rawPrediction"])]
    np.testing.assert_allclose(base + np.stack(rows["attribution"]).sum(axis=1), out, atol=1e-9)
    passes, _ = tree_attribution(model.transform(data), model, leaves_per_pass=7)
    some = passes.join(made.select(KEY, F.col("attribution").alias("whole")), KEY).select("attribution", "whole").limit(40).toPandas()
    np.testing.assert_allclose(np.stack(some["attribution"]), np.stack(some["whole"]), atol=1e-12)
    leaves, _ = ensemble_leaves(spark, model)
    for i in range(3):
        np.testing.assert_allclose(rows["attribution"][i], brute_shapley(rows["features"][i].toArray(), leaves, 3), atol=1e-9)
    assert shapley_values(np.zeros((2, 3)), []).shape == (2, 3)


def test_linear_explanations(spark, signal):
    columns = ["num_a", "num_b", "cat_a"]
    fitted = training.fit_baseline(signal, columns, LABEL)
    scorer = scoring.Scorer(fitted, {"model_name": "b", "optimal_threshold": 0.5, "promoted": True, "input_feature_columns": columns})
    made = explain_job(scorer, signal, LABEL, sample=300, examples=4, top_n=2)
    check = made.additivity.first()
    assert check["passed"] and made.rows.count() == 300 and made.output_space == "margin"
    assert made.importance.orderBy("rank").first()["feature"] == "num_a"
    local = made.examples.collect()
    assert len(local) == 4 and local[0]["reason"] == "highest_risk" and len(local[0]["top_positive"]) <= 2
    assert local[0]["threshold"] == 0.5 and {r["predicted_class"] for r in local} <= {0, 1} and {r["actual_class"] for r in local} <= {0, 1}
    assert all(c["attribution"] > 0 for c in local[0]["top_positive"])


def test_local_examples_are_distinct_and_topped_up(spark):
    df = spark.createDataFrame([(i, i / 10, int(i > 7)) for i in range(10)], "id long, p double, y int")
    got = [(r["reason"], r["id"]) for r in attribution.local_examples(df, "id", "p", 0.85, 5, "y").orderBy("position").collect()]
    assert got == [("highest_risk", 9), ("lowest_risk", 0), ("nearest_threshold", 8), ("high_risk_3", 7), ("high_risk_4", 6)]
    assert attribution.local_examples(df, "id", "p", 0.85, 50).count() == 10


def test_monitoring_job(spark, signal, trained):
    scorer = scoring.Scorer.load(spark, trained[1])
    current = signal.withColumn("num_a", F.col("num_a") + 1.5).withColumn("CODE_GENDER", F.when(F.col(KEY) % 2 == 0, "F").otherwise("M"))
    result = monitor_job(scorer, signal, current, LABEL, folder=shared_folder(spark, "monitoring"))
    row = result.summary.first()
    assert row["data_drift_status"] == "critical" and row["overall_status"] == "critical" and row["labels_available"]
    assert "data_drift" in [r["area"] for r in result.actions.collect()]
    assert row["reference_rows"] == signal.count() and row["current_dataset"] == "current" and row["created_at"] is not None
    assert row["section_statuses"]["data_drift"] == "critical"
    assert result.features.filter("feature = 'num_a'").first()["drift_status"] == "critical"
    quiet = monitor_job(scorer, signal, current.drop(LABEL), LABEL).summary.first()
    assert quiet["performance_status"] == "not_available"
    with pytest.raises(ContractViolation, match="identical"):
        monitor_job(scorer, signal, signal, LABEL)
    profile = ScoreProfile.load(spark, f"{trained[1]}/score_profile")
    stored = monitor_job(scorer, signal, current, LABEL, score_profile=profile).prediction.first()
    fresh = result.prediction.first()
    assert stored["reference_n"] == profile.stats["n"] and stored["current_mean_probability"] == pytest.approx(fresh["current_mean_probability"])
    with pytest.raises(ContractViolation, match="threshold"):
        monitor_job(scorer, signal, current, LABEL, score_profile=replace(profile, threshold=-1.0))


def test_prepare_job_from_raw_tables(spark):
    ids = list(range(1, 31))
    make = spark.createDataFrame
    person = [(i, i % 2, 100.0 * i, 500.0 + i, 20.0 + i, -9000 - i, "Cash" if i % 3 else "Revolving") for i in ids]
    schema = ("SK_ID_CURR long, TARGET int, AMT_INCOME_TOTAL double, AMT_CREDIT double, AMT_ANNUITY double, DAYS_BIRTH int, "
              "NAME_CONTRACT_TYPE string")
    child = "SK_ID_CURR long, SK_ID_PREV long, AMT double"
    raw = {
        "application_train": make(person, schema), "application_test": make([(i + 100, *r[2:]) for i, r in zip(ids, person)],
                                                                           schema.replace("TARGET int, ", "")),
        "bureau": make([(i, i * 10 + k, float(i)) for i in ids for k in (0, 1)], "SK_ID_CURR long, SK_ID_BUREAU long, AMT_CREDIT_SUM double"),
        "bureau_balance": make([(i * 10, -i) for i in ids], "SK_ID_BUREAU long, MONTHS_BALANCE int"),
        **{n: make([(i, i * 7, float(i % 5)) for i in ids], child) for n in ("previous_application", "pos_cash", "credit_card", "installments")},
    }
    made = prepare_job(raw, shared_folder(spark, "prepared"), spark)
    train, test = spark.read.parquet(made["train"]), spark.read.parquet(made["test"])
    assert train.count() == test.count() == 30 and "DEBT_BURDEN_RATIO" in train.columns and "AGE_YEARS" in test.columns
    assert "prev_SK_ID_PREV_count" in made["dropped_columns"] and "prev_SK_ID_PREV_count" in test.columns
    assert set(train.columns) - {"TARGET"} <= set(test.columns)


class CountedPreprocessor(training.TabularPreprocessor):
    fits = 0

    def _fit(self, dataset):
        CountedPreprocessor.fits += 1
        return super()._fit(dataset)


def test_candidates_share_folds_and_preprocessors(signal, monkeypatch):
    monkeypatch.setattr(training, "TabularPreprocessor", CountedPreprocessor)
    monkeypatch.setattr(CountedPreprocessor, "fits", 0)
    columns = [c for c in signal.columns if c not in (KEY, LABEL)]
    searches = training.tune_candidates(signal, columns, LABEL, KEY, None, SPACES, 1, 2)
    assert len(searches) == 2 and CountedPreprocessor.fits == 3  # one per fold, one for all rows; not for each model


class WatchedRegression(training.LogisticRegression):
    """Notes the rows of its tasks and how many fits run at once."""

    tasks, running, most = [], 0, 0

    def _fit(self, dataset):
        kind = WatchedRegression
        kind.running += 1
        kind.most = max(kind.most, kind.running)
        kind.tasks.append(max(dataset.rdd.glom().map(len).collect()))
        try:
            return super()._fit(dataset)
        finally:
            kind.running -= 1


def test_learners_get_bounded_tasks_and_room(signal, monkeypatch):
    rows, columns = signal.count(), [c for c in signal.columns if c not in (KEY, LABEL)]
    size = training.held_bytes(rows, len(columns))
    monkeypatch.setattr(training, "TASK_BYTES", size // 10)
    monkeypatch.setattr(training, "CORE_BYTES", 1)
    monkeypatch.setattr(WatchedRegression, "tasks", [])
    model = WatchedRegression(featuresCol="features", labelCol=training.LABEL, weightCol=training.WEIGHT)
    training.tune("Watched", model, {"maxIter": [1, 2]}, signal.coalesce(1), columns, LABEL, KEY, 2, 2, parallelism=2)
    assert len(WatchedRegression.tasks) == 5 and max(WatchedRegression.tasks) <= rows // 5
    assert WatchedRegression.most == 1  # rows of two fits would not fit side by side


class WatchedBoosting(training.GBTClassifier):
    """Notes how many fits of any candidate run at once."""

    def _fit(self, dataset):
        with WatchedBoosting.lock:
            WatchedBoosting.running.append(self)
            WatchedBoosting.most = max(WatchedBoosting.most, len(WatchedBoosting.running))
            WatchedBoosting.fits += 1
        try:
            return super()._fit(dataset)
        finally:
            WatchedBoosting.running.remove(self)


def test_fits_of_all_candidates_fill_the_cores(signal, monkeypatch):
    monkeypatch.setattr(WatchedBoosting, "lock", threading.Lock(), raising=False)
    monkeypatch.setattr(WatchedBoosting, "running", [], raising=False)
    monkeypatch.setattr(WatchedBoosting, "most", 0, raising=False)
    monkeypatch.setattr(WatchedBoosting, "fits", 0, raising=False)
    common = dict(featuresCol="features", labelCol=training.LABEL, weightCol=training.WEIGHT, seed=3)
    monkeypatch.setattr(training, "tunable_models", lambda seed: {n: WatchedBoosting(**common) for n in ("one", "two")})
    space = {"maxIter": [2, 3], "maxDepth": [1, 2], "stepSize": [0.1, 0.3]}
    columns = [c for c in signal.columns if c not in (KEY, LABEL)]
    made = training.tune_candidates(signal, columns, LABEL, KEY, None, {"one": space, "two": space}, 3, 2)
    assert WatchedBoosting.fits == 2 * 3 * 2 + 2 and WatchedBoosting.most > 3  # three were the most before, of one candidate
    one, two = made.values()
    assert one.scores == two.scores and len(one.scores) == 3 and one.best_params == two.best_params


def test_kept_places_leave_the_forest_as_it_is(signal, monkeypatch):
    columns = [c for c in signal.columns if c not in (KEY, LABEL)]
    space, trees = {"numTrees": [5], "maxDepth": [6]}, []
    model = training.tunable_models()["Random Forest"]
    for place, kept in ((8, True), (10 ** 12, False)):
        monkeypatch.setattr(training, "PLACE_BYTES", place)
        best = training.tune("Random Forest", model, space, signal, columns, LABEL, KEY, 1, 2).best.stages[1]
        assert best.getOrDefault("cacheNodeIds") is kept
        trees.append(best.toDebugString.split("\n", 1)[1])
    assert trees[0] == trees[1] and not model.getOrDefault("cacheNodeIds")


def test_room_holds_back_what_does_not_fit():
    room, seen = training._Room(10), []

    def take(size):
        with room.taken(size):
            seen.append((size, room.held, room.running))
            time.sleep(0.02)

    with ThreadPool(8) as pool:
        pool.map(take, [4, 4, 4, 25, 4, 4], chunksize=1)
    assert all(held <= 10 or (size == 25 and n == 1) for size, held, n in seen) and max(n for _, _, n in seen) <= 2
    forest = training.tunable_models()["Random Forest"]
    deep = {forest.numTrees: 600, forest.maxDepth: 16, forest.minInstancesPerNode: 10}
    assert training.model_bytes(forest, deep, 10 ** 9) == 600 * 2 ** 17 * training.NODE_BYTES
    assert training.model_bytes(forest, deep, 1000) == 600 * 201 * training.NODE_BYTES


class Searched(Exception):
    pass


def check_whole_search(spark, tiny, monkeypatch, query, names):
    """The registered query searches the full spaces of ``names``."""
    import __spark_entry__ as entry_point

    def searched(candidates, df, columns, label, key, n_iter, folds, seed, *rest):
        assert {n: space for n, (_, space) in candidates.items()} == {n: training.SEARCH_SPACES[n] for n in names}
        assert (n_iter, folds, seed) == (20, 3, 42)
        raise Searched

    monkeypatch.setattr(training, "_searched", searched)
    with pytest.raises(Searched):
        entry_point.queries()[query](spark, tiny)


def test_train_job_query_searches_all(spark, tiny, monkeypatch):
    check_whole_search(spark, tiny, monkeypatch, "train_job", ["Random Forest", "Gradient Boosting"])


def test_tune_query_searches_all(spark, tiny, monkeypatch):
    check_whole_search(spark, tiny, monkeypatch, "tune", ["Gradient Boosting"])


def test_tuning_summary_query_searches_all(spark, tiny, monkeypatch):
    check_whole_search(spark, tiny, monkeypatch, "tuning_summary", ["Random Forest", "Gradient Boosting"])
