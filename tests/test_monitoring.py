"""Performance, drift, score drift, groups and the status roll-up."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.functions.columns import local_rows
from riskloom.operators import drift, fairness, performance, scores, selection, status
from riskloom.operators.contracts import ContractViolation

LABELS = ["psi_warning_threshold", "psi_critical_threshold", "ks_pvalue_threshold"]


@pytest.fixture(scope="module")
def separable(spark):
    rng = np.random.default_rng(0)
    y = np.r_[np.zeros(800, int), np.ones(200, int)]
    p = np.round(np.r_[rng.beta(2, 5, 800), rng.beta(5, 2, 200)], 2)
    return y, p, spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))


def brute_metrics(y, p):
    pairs = p[y == 1][:, None] - p[y == 0][None, :]
    auc = ((pairs > 0) + 0.5 * (pairs == 0)).mean()
    cuts = np.unique(p)[::-1]
    tp = np.array([((p >= c) & (y == 1)).sum() for c in cuts])
    hits = np.array([(p >= c).sum() for c in cuts])
    recall, precision = tp / (y == 1).sum(), tp / hits
    ap = (np.diff(np.r_[0, recall]) * precision).sum()
    f1 = 2 * precision * recall / (precision + recall + 1e-12)
    best = max(f1)
    return auc, ap, min(c for c, f in zip(cuts, f1) if f == best)


def test_rank_metrics_and_threshold(separable):
    y, p, df = separable
    auc, ap, cut = brute_metrics(y, p)
    row = performance.evaluate(df, "y", "p", 0.5).first()
    assert row["roc_auc"] == pytest.approx(auc, abs=1e-12) and row["average_precision"] == pytest.approx(ap, abs=1e-12)
    assert row["accuracy"] == pytest.approx(((p >= 0.5) == (y == 1)).mean())
    assert row["tp"] == ((p >= 0.5) & (y == 1)).sum() and row["n"] == 1000
    assert performance.f1_threshold(performance.score_curve(df, "y", "p")).first()["threshold"] == cut


def test_single_class_batch_is_refused(separable):
    _, _, df = separable
    with pytest.raises(ContractViolation, match="label_single_class"):
        performance.performance_report(df.filter("y = 0"), "y", "p", 0.5)


@pytest.mark.parametrize("rows, said", [
    ([(2, 0.5), (0, 0.2), (1, 0.7)], "label_other"), ([(1, float("nan")), (0, 0.2), (1, 0.7)], "score_null"),
    ([(1, float("inf")), (0, 0.2), (1, 0.7)], "score_null"), ([(1, None), (0, 0.2), (1, 0.7)], "score_null")])
def test_unusable_labels_and_scores_are_refused(spark, rows, said):
    df = spark.createDataFrame(rows, "y int, p double")
    with pytest.raises(ContractViolation, match=said):
        performance.performance_report(df, "y", "p", 0.5)


def test_confusion_counts_refuse_a_missing_score(spark):
    df = spark.createDataFrame([(1, None), (0, 0.2)], "y int, p double")
    with pytest.raises(Exception, match="score is missing"):
        performance.confusion_counts(df, "y", "p", 0.5).collect()


def test_a_column_that_fails_at_run_time_loses_only_itself(spark):
    ref = spark.range(200).select((F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 3).cast("string").alias("c"))
    cur = ref.withColumn("bad", F.expr("CASE WHEN x = 3 THEN raise_error('broken value') ELSE 'a' END")).withColumn(
        "worse", F.expr("CASE WHEN x = 3 THEN CAST(raise_error('broken number') AS DOUBLE) ELSE x END"))
    ref = ref.withColumn("bad", F.lit("a")).withColumn("worse", F.col("x"))
    report = {r["feature"]: r["drift_status"] for r in drift.drift_report(ref, cur, ["x", "worse"], ["c", "bad"]).collect()}
    assert report == {"x": "stable", "c": "stable", "bad": "error", "worse": "error"}


def test_other_errors_are_raised(spark, monkeypatch):
    def lost(*_):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(drift, "categorical_drift", lost)
    df = spark.range(50).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(RuntimeError, match="executor lost"):
        drift.drift_report(df, df, [], ["c"])


def test_report_without_labels_holds_no_metric(separable):
    _, _, df = separable
    row = performance.performance_report(df.drop("y"), "y", "p", 0.5).first()
    assert row["status"] == "not_available" and not row["labels_available"] and "roc_auc" not in row.asDict()


def test_degradation_levels(separable):
    _, _, df = separable
    ap = performance.evaluate(df, "y", "p", 0.5).first()["average_precision"]
    for drop, want in ((0.0, "healthy"), (0.03, "warning"), (0.08, "critical")):
        row = performance.performance_report(df, "y", "p", 0.5, {}, {"Average Precision": ap + drop, "text": "x"}).first()
        assert row["status"] == want
    failed = performance.performance_report(df, "y", "p", 0.5, {"min_recall": 1.0}).first()
    assert failed["status"] == "critical" and "below floor: Recall" in failed["reasons"]


def frames(spark, ref, cur):
    return spark.createDataFrame(pd.DataFrame(ref)), spark.createDataFrame(pd.DataFrame(cur))


def test_psi_identities(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(0, 1, 3000)
    ref, cur = frames(spark, {"same": base, "small": base, "large": base, "flat": 1.0},
                      {"same": base, "small": rng.normal(0.2, 1, 3000), "large": rng.normal(1.5, 1, 3000), "flat": 2.0})
    got = {r["feature"]: r for r in drift.psi(ref, cur, list(ref.columns)).collect()}
    assert got["same"]["psi"] == pytest.approx(0, abs=1e-12) and got["flat"]["psi"] == 0.0
    assert 0 < got["small"]["psi"] < 0.1 < 0.25 < got["large"]["psi"] and 0 <= got["large"]["js"] <= 1


def test_ks_pvalue_matches_the_series(spark):
    df = spark.createDataFrame([(0.05, 500, 400), (0.0, 100, 100), (1.0, 900, 900), (0.1, 300, 200)], "d double, n long, m long")
    for r in df.select("*", drift.ks_pvalue(F.col("d"), F.col("n"), F.col("m")).alias("p")).collect():
        en = math.sqrt(r["n"] * r["m"] / (r["n"] + r["m"]))
        lam = (en + 0.12 + 0.11 / en) * r["d"]
        want = 1.0 if lam < 0.2 else 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
        assert r["p"] == pytest.approx(min(max(want, 0.0), 1.0), abs=1e-12)


def test_report_survives_broken_features_and_orders_them(spark):
    rng = np.random.default_rng(4)
    ref = spark.createDataFrame([(float(a), "a" if a > 0 else "b", None, [1]) for a in rng.normal(0, 1, 400)],
                                "moved double, cat string, void double, odd array<int>")
    cur = spark.createDataFrame([(float(a), "NEW" if a > 2 else "a", None, [1]) for a in rng.normal(2, 1, 400)], ref.schema)
    report = drift.drift_report(ref, cur, ["void", "moved", "odd", "gone"], ["cat"])
    got = {r["feature"]: r for r in report.collect()}
    assert got["moved"]["drift_status"] == "critical" and got["void"]["drift_status"] == "insufficient_data"
    assert got["odd"]["drift_status"] == "error" and got["gone"]["drift_reason"] == "absent from reference or current batch"
    assert got["cat"]["unseen_category_rate"] > 0.3
    assert [r["feature"] for r in drift.ordered(report).collect()][:2] in (["moved", "cat"], ["cat", "moved"])
    top = drift.summarise(report).first()
    assert top["status"] == "critical" and top["error_features"] == 1 and top["monitored_features"] == 5


def classify(spark, **values):
    known = {"psi": 0.0, "reference_n": 100, "current_n": 100, "missing_rate_change": 0.0, "ks_pvalue": 1.0, "ks_statistic": 0.0,
             "unseen_category_rate": 0.0, **values}
    schema = ", ".join(f"{k} {'long' if k.endswith('_n') else 'double'}" for k in known)
    row = drift.classified(local_rows(spark, [tuple(known.values())], schema)).first()
    return row["drift_status"], row["drift_reason"]


def test_classification_rules(spark):
    assert classify(spark) == ("stable", "within thresholds")
    assert classify(spark, psi=0.3)[0] == "critical" and classify(spark, psi=0.1)[0] == "warning"
    assert classify(spark, ks_pvalue=0.0, ks_statistic=0.04)[0] == "stable"
    assert classify(spark, ks_pvalue=0.0, ks_statistic=0.9)[0] == "warning"
    assert classify(spark, unseen_category_rate=0.004)[0] == "stable" and classify(spark, unseen_category_rate=0.01)[0] == "warning"
    assert classify(spark, missing_rate_change=-0.06) == ("warning", "missing rate moved -6.0%")
    assert classify(spark, psi=None)[1] == "PSI could not be computed" and classify(spark, current_n=29)[0] == "insufficient_data"


def test_warnings_alone_can_be_critical(spark):
    rows = [("a", "warning")] * 3 + [("b", "stable")] * 7
    report = local_rows(spark, rows, "feature string, drift_status string")
    assert drift.summarise(report, 0.2).first()["status"] == "critical"
    assert drift.summarise(report, 0.5).first()["status"] == "warning"


def test_prediction_drift(spark):
    rng = np.random.default_rng(6)
    ref, cur = frames(spark, {"p": rng.beta(2, 5, 2000)}, {"p": rng.beta(5, 2, 2000)})
    same = scores.prediction_drift(ref, ref, "p", 0.6916).first()
    assert same["status"] == "stable" and same["probability_psi"] == pytest.approx(0, abs=1e-9)
    moved = scores.prediction_drift(ref, cur, "p", 0.6916).first()
    assert moved["status"] == "critical" and moved["mean_probability_change"] > 0.3 and "positive rate moved" in moved["reasons"]
    with pytest.raises(ValueError, match=r"\[0, 1\]"):
        scores.prediction_drift(ref, cur.withColumn("p", F.col("p") * 3), "p", 0.5)
    with pytest.raises(ValueError, match="no predictions"):
        scores.describe_scores(ref.filter("false"), "p", 0.5)


@pytest.mark.parametrize("shape", ["spread", "constant", "two values"])
def test_stored_score_profile(spark, tmp_path, shape):
    """The stored profile gives the comparison that the reference's rows give."""
    rng = np.random.default_rng(16)
    values = {"spread": rng.beta(2, 5, 3000), "constant": np.full(3000, 0.25), "two values": rng.choice([0.1, 0.7], 3000)}[shape]
    ref, cur = frames(spark, {"p": values}, {"p": rng.beta(5, 2, 2000)})
    ref = ref.select("p").unionByName(local_rows(spark, [(None,), (float("nan"),)], "p double"))
    path = scores.ScoreProfile.of(ref, "p", 0.4).save(spark, f"{tmp_path}/profile")
    stored = scores.ScoreProfile.load(spark, path)
    got, want = scores.prediction_drift_from(stored, cur, "p").first(), scores.prediction_drift(ref, cur, "p", 0.4).first()
    assert got.asDict().keys() == want.asDict().keys()
    for k, v in want.asDict().items():
        assert got[k] == (pytest.approx(v, rel=1e-9, abs=1e-9) if isinstance(v, float) else v), k
    with pytest.raises(ValueError, match="no predictions"):
        scores.prediction_drift_from(stored, cur.filter("false"), "p")


def test_merged_score_profiles(spark):
    rng = np.random.default_rng(17)
    first, second = (local_rows(spark, [(float(x),) for x in rng.beta(a, 3, 900)], "p double") for a in (2, 4))
    base = scores.ScoreProfile.of(first, "p", 0.4)
    more = scores.ScoreProfile.of(second, "p", 0.4)
    with pytest.raises(ValueError, match="different"):
        base.merged(more)
    one = second.selectExpr("p", "0 AS side")
    whole = base.merged(scores.ScoreProfile(0.4, more.stats, more.median, base.edges, scores._bin_counts(one, base.edges)))
    both = scores.ScoreProfile.of(first.unionByName(second), "p", 0.4)
    assert whole.stats == pytest.approx(both.stats) and whole.counts["fixed"] == both.counts["fixed"]
    assert sum(whole.counts["quantile"]) == both.stats["n"]


def test_identical_batches(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "a int, b string")
    assert drift.batches_identical(a, a.select("b", "a"))
    assert not drift.batches_identical(a, spark.createDataFrame([(1, "x"), (2, None), (2, None)], a.schema))


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(8)
    n = 400
    gender = np.array(["A"] * 200 + ["B"] * 190 + ["TINY"] * 10)
    p = np.where(gender == "A", rng.uniform(0.6, 1, n), rng.uniform(0, 0.4, n))
    return spark.createDataFrame(pd.DataFrame({"CODE_GENDER": gender, "NAME_INCOME_TYPE": np.where(np.arange(n) % 2, "W", "P"),
                                               "p": p, "y": rng.integers(0, 2, n)}))


def test_small_groups_are_reported_not_merged(people):
    groups = {r["group_value"]: r for r in fairness.group_metrics(people, ["CODE_GENDER"], "p", 0.5, "y").collect()}
    assert groups["TINY"]["status"] == "insufficient_data" and groups["TINY"]["recall"] is None and groups["TINY"]["n"] == 10
    assert groups["A"]["positive_prediction_rate"] == 1.0 and groups["B"]["precision"] == 0.0
    unlabelled = fairness.group_metrics(people, ["CODE_GENDER"], "p", 0.5).filter("group_value = 'A'").first()
    assert unlabelled["recall"] is None and unlabelled["mean_probability"] > 0.6


def test_fairness_report(people):
    row, groups = fairness.fairness_report(people, "p", 0.5, label="y")
    got = row.first()
    assert got["status"] == "warning" and got["columns_absent"] == "NAME_FAMILY_STATUS,NAME_EDUCATION_TYPE"
    assert "CODE_GENDER: positive-prediction-rate spread 1.000 exceeds 0.1" in got["reasons"] and groups.count() == 5
    assert fairness.fairness_report(people.drop("CODE_GENDER", "NAME_INCOME_TYPE"), "p", 0.5)[0].first()["status"] == "not_available"
    assert fairness.fairness_report(people, "p", 0.5, {"enabled": False})[0].first()["status"] == "not_available"
    high = {**fairness.FAIRNESS_LIMITS, "minimum_group_size": 5000}
    assert fairness.fairness_report(people, "p", 0.5, high)[0].first()["status"] == "insufficient_data"
    assert fairness.escalated(fairness.group_disparity(groups), 0.1).first()["status"] == "critical"


@pytest.mark.parametrize("statuses, want", [
    ([], "not_available"), (["stable", "not_available"], "not_available"), (["warning", "insufficient_data"], "warning"),
    (["error", "insufficient_data"], "error"), (["stable", "critical", "warning"], "critical")])
def test_overall_status(spark, statuses, want):
    rows = local_rows(spark, [(i, f"s{i}", s) for i, s in enumerate(statuses)], "position int, section string, status string")
    assert status.overall_status(rows).first()["overall_status"] == want


def candidates(spark):
    return selection.candidate_table(spark, [
        {"Model": "a", "Average Precision": 0.2, "ROC-AUC": 0.8, "Recall": 0.1},
        {"Model": "b", "Average Precision": 0.3, "ROC-AUC": 0.6}, {"Model": "c", "Average Precision": 0.1, "ROC-AUC": 0.7}])


def test_selection(spark):
    table = candidates(spark)
    assert [r["Model"] for r in selection.leaderboard(table).collect()] == ["b", "a", "c"]
    best = selection.select_champion(table).first()
    assert best["Model"] == "b" and not best["promoted"] and best["gate_failures"] == ["ROC-AUC=0.6000 is below the required 0.65"]
    assert selection.select_champion(table, {"ROC-AUC": 0.5}).first()["promoted"]
    missing = selection.check_operational_gates(table).filter("Model = 'b'").first()
    assert not missing["operational"] and "missing" in missing["operational_failures"][0]
    with pytest.raises(ValueError, match="threshold"):
        selection.check_quality_gates(table, {"Recall": 0.1})
    with pytest.raises(ValueError, match="no candidates"):
        selection.leaderboard(table.filter("false"))
    with pytest.raises(ValueError, match="lack"):
        selection.leaderboard(table, "Recall")


def test_histogram_code_does_not_grow_with_the_edges(spark):
    """Bins are searched, not compared edge by edge; values on an edge belong to the bin above it."""
    rows = [(float(v), i % 2) for i, v in enumerate([-9, 0, 0.5, 1, 1.5, 2, 3, 99])] + [(None, 0)]
    both = spark.createDataFrame(rows, "`a.b` double, side int").select("*", *[F.col("`a.b`").alias(f"c{i}") for i in range(30)])
    edges = {c: [0.0, 1.0, 2.0, 3.0] for c in ["a.b", *[f"c{i}" for i in range(30)]]}
    found = drift.histogram_parts(both, edges).collect()
    assert len(found) == 93
    for r in found:
        assert (r["ref"], r["cur"]) == {0: (2, 1), 1: (1, 1), 2: (1, 2)}[r["part"]]
