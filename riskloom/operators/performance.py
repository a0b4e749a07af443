"""Labelled performance: confusion counts, rank metrics, threshold choice, gates and degradation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import count_if, finite, local_rows, named, share
from riskloom.functions.ranges import running_totals
from riskloom.operators.contracts import check_scored, require
from riskloom.operators.drift import CRITICAL, STABLE, WARNING

HEALTHY, NOT_AVAILABLE = "healthy", "not_available"

# Metric names, the gate that constrains each, and how far a metric may fall.
METRICS = ("Average Precision", "ROC-AUC", "Accuracy", "Precision", "Recall", "F1")
GATES = {
    "min_average_precision": "Average Precision", "min_roc_auc": "ROC-AUC", "min_recall": "Recall",
    "min_precision": "Precision", "min_f1": "F1",
}
MONITORING_FLOORS = {
    "min_average_precision": 0.15, "min_roc_auc": 0.65, "min_recall": 0.35, "min_precision": 0.20, "min_f1": 0.25,
}
FALL_WARNING, FALL_CRITICAL = 0.02, 0.05

#: The column that holds each metric.
NAMES = {"Average Precision": "average_precision", "ROC-AUC": "roc_auc", "Accuracy": "accuracy", "Precision": "precision",
         "Recall": "recall", "F1": "f1"}


def confusion_counts(df: DataFrame, label: str, score: str, threshold: float, keys: Sequence[str] = ()) -> DataFrame:
    """Counts per key. A score that is missing or not finite stops the job rather than vanish from the counts."""
    p = finite(named(score))
    y, hit = named(label).cast("int"), F.when(p.isNull(), F.raise_error(F.lit(f"a {score} score is missing or not finite"))
                                             .cast("boolean")).otherwise(p >= F.lit(float(threshold)))
    plan = [count_if((y == 0) & ~hit).alias("tn"), count_if((y == 0) & hit).alias("fp"),
            count_if((y == 1) & ~hit).alias("fn"), count_if((y == 1) & hit).alias("tp")]
    return df.groupBy(*[named(k) for k in keys]).agg(*plan)


def threshold_metrics(counts: DataFrame) -> DataFrame:
    """Add the metrics that four confusion counts determine; an empty denominator gives 0."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    return counts.select(
        "*", n.cast("long").alias("n"), share(tp + tn, n).alias("accuracy"),
        share(tp, tp + fp, 0.0).alias("precision"), share(tp, tp + fn, 0.0).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn, 0.0).alias("f1"), share(fp, fp + tn, 0.0).alias("false_positive_rate"),
        share(fn, fn + tp, 0.0).alias("false_negative_rate"),
        share(tp + fp, n).alias("predicted_positive_rate"), share(tp + fn, n).alias("actual_positive_rate"))


def score_curve(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Per distinct score, from the highest down: positives and negatives at it and down to it."""
    y = named(label).cast("double")
    classes = {"tp": F.when(y == 1, 1).otherwise(0).cast("long"), "fp": F.when(y == 0, 1).otherwise(0).cast("long")}
    return running_totals(df, score, classes, keys, descending=True)


def precision_recall_curve(curve: DataFrame) -> DataFrame:
    hits = F.col("cum_tp") + F.col("cum_fp")
    keep = [c for c in curve.columns if c not in {"value", "tp", "fp", "cum_tp", "cum_fp", "all_tp", "all_fp"}]
    return curve.select(*keep, F.col("value").alias("threshold"), (F.col("cum_tp") / hits).alias("precision"),
                        share(F.col("cum_tp").cast("double"), F.col("all_tp"), 0.0).alias("recall"))


def _rank_aggregates() -> list[Column]:
    tp, fp, upto = F.col("tp"), F.col("fp"), F.col("cum_tp")
    positives, negatives = F.sum(tp).cast("double"), F.sum(fp).cast("double")
    area = F.sum(fp.cast("double") * (upto - tp / 2))
    steps = F.sum(tp * upto / (upto + F.col("cum_fp")))
    return [F.try_divide(area, positives * negatives).alias("roc_auc"),
            F.try_divide(steps, positives).alias("average_precision")]


def rank_metrics(curve: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC (ties count half) and average precision (step sum), undefined with a single class."""
    return curve.groupBy(*keys).agg(*_rank_aggregates())


def f1_threshold(curve: DataFrame) -> DataFrame:
    """The score with the best F1; the lowest one among ties."""
    p, r = F.col("precision"), F.col("recall")
    scored = precision_recall_curve(curve).withColumn("f1", 2 * p * r / (p + r + 1e-12))
    return scored.orderBy(F.col("f1").desc(), F.col("threshold").asc()).limit(1)


def evaluate(df: DataFrame, label: str, score: str, threshold: float = 0.5, keys: Sequence[str] = ()) -> DataFrame:
    """All metrics per key (say, per model) or for the whole table.

    The curve already holds the class counts per score, so the confusion counts come out of the same
    aggregation as the rank metrics.
    """
    curve = score_curve(df, label, score, keys)
    hit = F.col("value") >= F.lit(float(threshold))
    counts = [F.sum(F.when(~hit, F.col("fp")).otherwise(0)).alias("tn"),
              F.sum(F.when(hit, F.col("fp")).otherwise(0)).alias("fp"),
              F.sum(F.when(~hit, F.col("tp")).otherwise(0)).alias("fn"),
              F.sum(F.when(hit, F.col("tp")).otherwise(0)).alias("tp")]
    return threshold_metrics(curve.groupBy(*keys).agg(*counts, *_rank_aggregates()))


def metric_rows(evaluated: DataFrame) -> DataFrame:
    """One evaluated row as ``(metric, value)`` under the names that gates and baselines use."""
    return evaluated.select(*[F.col(c).alias(m) for m, c in NAMES.items()]).unpivot([], list(NAMES), "metric", "value")


def small_table(spark, values: Mapping[str, float], schema: str) -> DataFrame:
    return local_rows(spark, [(k, float(v)) for k, v in values.items()], schema)


def gate_check(metrics: DataFrame, gates: Mapping[str, float] = MONITORING_FLOORS) -> DataFrame:
    """``(metric, value, floor, passed)``; a gate without its metric is skipped."""
    floors = {GATES[g]: v for g, v in gates.items() if g in GATES}
    return metrics.join(small_table(metrics.sparkSession, floors, "metric string, floor double"), "metric").filter(
        F.col("value").isNotNull()).select("metric", "value", "floor", (F.col("value") >= F.col("floor")).alias("passed"))


def compare_to_baseline(metrics: DataFrame, baseline: Mapping[str, float]) -> DataFrame:
    """``(metric, current, baseline, change)`` for the metrics both sides have."""
    known = {k: v for k, v in baseline.items() if k in METRICS and isinstance(v, (int, float))}
    return metrics.join(small_table(metrics.sparkSession, known, "metric string, baseline double"), "metric").select(
        "metric", F.col("value").alias("current"), "baseline", (F.col("value") - F.col("baseline")).alias("change"))


def _drop(change: Column) -> Column:
    return -change


# Fixed formats: the wording of reasons in the performance report.
def _said_floor(g: Column) -> Column:
    return F.format_string("below floor: %s %.4f vs floor %.4f", g["metric"], g["value"], g["floor"])


def _said_fall(c: Column) -> Column:
    drop = _drop(c["change"])
    return F.concat(F.format_string("%s fell %.4f below the champion's test baseline ", c["metric"], drop),
                    F.when(drop >= FALL_CRITICAL, F.lit(f"(critical at {FALL_CRITICAL})"))
                    .otherwise(F.lit(f"(warning at {FALL_WARNING})")))


def _judged(evaluated: DataFrame, gates: Mapping[str, float], baseline: Mapping[str, float]) -> DataFrame:
    """One row of metrics with its gates, changes, status and reasons. All come from expressions over that row: nothing
    is joined or shuffled beyond what the metrics need. A failed floor or a deep fall is critical, a smaller fall a warning."""
    floors = {GATES[g]: float(v) for g, v in gates.items() if g in GATES}
    known = {k: float(v) for k, v in baseline.items() if k in METRICS and isinstance(v, (int, float))}
    checks = [F.struct(F.lit(m).alias("metric"), F.col(NAMES[m]).alias("value"), F.lit(floors[m]).alias("floor"))
              for m in METRICS if m in floors]
    changes = [F.struct(F.lit(m).alias("metric"), F.col(NAMES[m]).alias("current"), F.lit(known[m]).alias("baseline"),
                        (F.col(NAMES[m]) - F.lit(known[m])).alias("change")) for m in METRICS if m in known]
    empty = {"checks": "array<struct<metric: string, value: double, floor: double>>",
             "baseline_comparison": "array<struct<metric: string, current: double, baseline: double, change: double>>"}
    columns = {k: F.array(*own) if own else F.array().cast(empty[k]) for k, own in (("checks", checks), ("baseline_comparison", changes))}
    held = evaluated.withColumns(columns).withColumn("checks", F.filter("checks", lambda g: g["value"].isNotNull()))
    passed = lambda g: g["value"] >= g["floor"]
    failed, fallen = F.filter("checks", lambda g: ~passed(g)), F.filter("baseline_comparison", lambda c: _drop(c["change"]) >= FALL_WARNING)
    lines = F.concat(F.transform(failed, _said_floor), F.transform(fallen, _said_fall))
    worst = (F.size(failed) > 0) | F.exists("baseline_comparison", lambda c: F.coalesce(_drop(c["change"]) >= FALL_CRITICAL, F.lit(False)))
    return held.select(
        *evaluated.columns, F.transform(F.filter("checks", passed), lambda g: g["metric"]).alias("gates_passed"),
        F.transform(failed, lambda g: g["metric"]).alias("gates_failed"), "baseline_comparison",
        F.when(worst, CRITICAL).when(F.size(fallen) > 0, WARNING).otherwise(HEALTHY).alias("status"),
        F.when(F.size(lines) > 0, F.concat_ws("; ", lines))
        .otherwise(F.lit("all gates passed and no material degradation")).alias("reasons"))


def performance_report(df: DataFrame, label: str | None, score: str, threshold: float,
                       gates: Mapping[str, float] = MONITORING_FLOORS,
                       baseline: Mapping[str, float] | None = None) -> DataFrame:
    """One row. Without labels it says so and holds no metric; one class only is refused."""
    spark = df.sparkSession
    if label is None or label not in df.columns:
        return local_rows(spark, [(False, NOT_AVAILABLE, "the batch carries no observed outcomes")],
                                     "labels_available boolean, status string, reasons string")
    require(check_scored(df, label, score))
    made = _judged(evaluate(df, label, score, threshold), gates, baseline or {})
    record = local_rows(spark, [tuple(made.first().asDict(recursive=True).values())], made.schema)  # read again without the batch
    kept = [c for c in record.columns if c not in ("status", "reasons")]
    return record.select(*kept, F.lit(float(threshold)).alias("threshold"), "status", "reasons", F.lit(True).alias("labels_available"))


def normalise_status(df: DataFrame, column: str = "status") -> DataFrame:
    return df.withColumn(column, F.when(F.col(column) == HEALTHY, STABLE).otherwise(F.col(column)))
