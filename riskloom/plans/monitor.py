"""Monitoring of a current batch against the rows the champion was fitted on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from riskloom.operators.contracts import ContractViolation
from riskloom.operators.drift import (
    DRIFT_LIMITS, MAX_DRIFTED_RATIO, batch_intake, batches_identical, drift_report, summarise)
from riskloom.operators.fairness import FAIRNESS_LIMITS, GROUP_COLUMNS, fairness_report
from riskloom.operators.performance import MONITORING_FLOORS, performance_report
from riskloom.operators.scores import PREDICTION_LIMITS, ScoreProfile, prediction_drift, prediction_drift_from
from riskloom.operators.scoring import Scorer
from riskloom.operators.status import monitoring_summary, recommended_actions
from riskloom.session import shared_folder
from riskloom.sources.sinks import write_csv, write_json, write_parquet


@dataclass
class MonitoringResult:
    features: DataFrame
    drift: DataFrame
    prediction: DataFrame
    performance: DataFrame
    fairness: DataFrame
    groups: DataFrame | None
    summary: DataFrame
    actions: DataFrame


def monitor_job(scorer: Scorer, reference: DataFrame, current: DataFrame, label: str, sample: int | None = None,
                group_columns: Sequence[str] = GROUP_COLUMNS, drift_limits: Mapping[str, float] = DRIFT_LIMITS,
                max_drifted_ratio: float = MAX_DRIFTED_RATIO, prediction_limits: Mapping[str, float] = PREDICTION_LIMITS,
                floors: Mapping[str, float] = MONITORING_FLOORS, fairness_limits: Mapping = FAIRNESS_LIMITS,
                folder: str | None = None, names: tuple[str, str] = ("reference", "current"),
                score_profile: ScoreProfile | None = None) -> MonitoringResult:
    """All sections over all rows; ``sample`` bounds each side on request only. With the profile that training stored, the
    scores are compared without the reference's rows.

    Both scored batches are written once to the shared folder, because every section reads them and
    scoring twice would cost more than reading back.
    """
    spark, key = reference.sparkSession, scorer.deployment.id_column
    reference, _ = batch_intake(reference, key, label, sample)
    current, labelled = batch_intake(current, key, label, sample)
    inputs = scorer.expected_columns
    if batches_identical(reference.select(*inputs), current.select(*inputs)):
        raise ContractViolation("reference and current batch are identical: no drift by construction")

    where = folder or shared_folder(spark, "monitor")

    def scored(df: DataFrame, name: str, extra: tuple[str, ...]) -> DataFrame:
        have = tuple(dict.fromkeys(c for c in (key, *extra, *inputs) if c in df.columns))
        return spark.read.parquet(write_parquet(scorer.scored(df, have), f"{where}/{name}"))

    before = scored(reference, "reference_scored", ())
    after = scored(current, "current_scored", (label, *group_columns))
    numeric, categorical = scorer.preprocessor.feature_types()
    threshold = scorer.deployment.optimal_threshold

    features = drift_report(before, after, numeric, categorical, drift_limits)
    features = spark.read.parquet(write_parquet(features, f"{where}/feature_drift"))
    drift = summarise(features, max_drifted_ratio)
    if score_profile is None:
        prediction = prediction_drift(before, after, "DEFAULT_PROBABILITY", threshold, prediction_limits, drift_limits)
    elif score_profile.threshold != threshold:
        raise ContractViolation(f"the score profile's threshold {score_profile.threshold} is not the champion's {threshold}")
    else:
        prediction = prediction_drift_from(score_profile, after, "DEFAULT_PROBABILITY", prediction_limits, drift_limits)
    performance = performance_report(after, label if labelled else None, "DEFAULT_PROBABILITY", threshold, floors,
                                     scorer.deployment.test_metrics)
    fairness, groups = fairness_report(after, "DEFAULT_PROBABILITY", threshold, fairness_limits,
                                       label if labelled else None, group_columns)
    described = {"reference_dataset": names[0], "current_dataset": names[1], "reference_rows": before.count(),
                 "current_rows": after.count(), "created_at": datetime.now(timezone.utc)}
    summary = monitoring_summary(drift, prediction, performance, fairness, described)
    summary = spark.read.parquet(write_parquet(summary, f"{where}/summary"))
    if folder:
        write_csv(features, f"{folder}/feature_drift_csv")
        write_json(prediction, f"{folder}/prediction_drift")
        write_json(performance, f"{folder}/performance")
        if groups is not None:
            write_csv(groups, f"{folder}/fairness_csv")
        write_json(summary, f"{folder}/summary_json")
    return MonitoringResult(features, drift, prediction, performance, fairness, groups, summary,
                            recommended_actions(summary))
