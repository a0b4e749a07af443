"""Monitoring roll-up: the worst section decides, and every section stays visible."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.drift import CRITICAL, ERROR, INSUFFICIENT, STABLE, WARNING
from riskloom.operators.performance import HEALTHY, NOT_AVAILABLE

# Rank of each status, worst highest.
RANK = {CRITICAL: 4, WARNING: 3, INSUFFICIENT: 2, ERROR: 2, NOT_AVAILABLE: 1, STABLE: 0, HEALTHY: 0}


def status_rank(status):
    out = F.lit(0)
    for name, rank in RANK.items():
        out = F.when(status == name, F.lit(rank)).otherwise(out)
    return out


def overall_status(sections: DataFrame) -> DataFrame:
    """Worst of ``(position, section, status)``; among equals the first section; none: not available."""
    worst = F.max_by("status", F.struct(status_rank(F.col("status")), -F.col("position")))
    return sections.agg(F.coalesce(worst, F.lit(NOT_AVAILABLE)).alias("overall_status"),
                        F.count(F.lit(1)).alias("sections"))


def monitoring_summary(drift: DataFrame, prediction: DataFrame, performance: DataFrame, fairness: DataFrame,
                       described: Mapping[str, object] | None = None) -> DataFrame:
    """One row out of four one-row sections, with a map from section to status.

    ``described`` adds what the sections do not know: names and sizes of the batches, the time of the run.
    """
    sections = [
        drift.select(F.col("status").alias("data_drift_status"), "monitored_features", "warning_features",
                     "critical_features", "drifted_feature_ratio"),
        prediction.select(F.col("status").alias("prediction_drift_status"), "positive_rate_change"),
        performance.select(F.when(F.col("status") == HEALTHY, STABLE).otherwise(F.col("status"))
                           .alias("performance_status"), "labels_available"),
        fairness.select(F.col("status").alias("fairness_status")),
    ]
    # every column is filled by one section only, so a maximum per column lines the sections up
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sections)
    joined = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    names = ["data_drift_status", "prediction_drift_status", "performance_status", "fairness_status"]
    # the rank is what decides; the place only breaks ties towards the first section
    worst = F.array_max(F.array(*[
        F.struct(status_rank(F.col(c)).alias("rank"), F.lit(-i).alias("place"), F.col(c).alias("status"))
        for i, c in enumerate(names)]))
    statuses = F.create_map(*[x for c in names for x in (F.lit(c.removesuffix("_status")), F.col(c))])
    return joined.withColumn("overall_status", worst["status"]).withColumn("section_statuses", statuses).withColumns(
        {k: F.lit(v) for k, v in (described or {}).items()})


def recommended_actions(summary: DataFrame) -> DataFrame:
    """``(position, area, action)`` rows implied by the statuses of a summary row."""
    alarm = [WARNING, CRITICAL]
    drift, prediction = F.col("data_drift_status"), F.col("prediction_drift_status")
    performance, groups = F.col("performance_status"), F.col("fairness_status")
    rules = [
        ("data_drift", drift == CRITICAL, F.format_string(
            "investigate %d critical feature(s) before trusting new scores", "critical_features")),
        ("data_drift", drift == WARNING, F.format_string("review %d warning feature(s)", "warning_features")),
        ("prediction_drift", prediction.isin(alarm), F.format_string(
            "score distribution moved (positive rate %+.4f): confirm downstream volumes", "positive_rate_change")),
        ("performance", ~F.col("labels_available"), F.lit("monitor again once outcomes are known")),
        ("performance", F.col("labels_available") & performance.isin(alarm), F.lit(
            "below a floor or the baseline: decide on retraining")),
        ("fairness", groups.isin(alarm), F.lit("group differences exceed the limits: review")),
    ]
    cells = [F.when(cond, F.struct(F.lit(i).alias("position"), F.lit(area).alias("area"), text.alias("action")))
             for i, (area, cond, text) in enumerate(rules)]
    nothing = F.array(F.struct(F.lit(len(rules)).alias("position"), F.lit("none").alias("area"),
                               F.lit("no action indicated").alias("action")))
    found = F.array_compact(F.array(*cells))
    return summary.select(F.inline(F.when(F.size(found) > 0, found).otherwise(nothing)))
