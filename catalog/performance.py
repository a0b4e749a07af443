"""Labelled performance, groups, and the monitoring roll-up."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.aggregates import BASELINE, METRICS_SQL, metrics
from catalog.inputs import SCORED_SQL, scored
from catalog.registry import query, r, rounded, table
from catalog.sets_and_order import CANDIDATES_SQL, candidate_metrics, candidates, group_sql
from riskloom.functions.columns import local_rows
from riskloom.operators import fairness, performance, selection, status


@query("threshold_metrics", f"""WITH {METRICS_SQL} SELECT tn::BIGINT AS tn, fp::BIGINT AS fp, fn::BIGINT AS fn, tp::BIGINT AS tp,
{r('(tp + tn) / (tp + tn + fp + fn)', 'accuracy')}, {r('tp / (tp + fp)', 'precision')}, {r('tp / (tp + fn)', 'recall')},
{r('2 * tp / (2 * tp + fp + fn)', 'f1')} FROM cf""")
def threshold_metrics(spark, folder):
    counts = performance.confusion_counts(scored(spark, folder), "y", "p", 0.2)
    return rounded(performance.threshold_metrics(counts).select("tn", "fp", "fn", "tp", "accuracy", "precision", "recall", "f1"))


@query("error_rates", f"""WITH {METRICS_SQL} SELECT (tn + fp + fn + tp)::BIGINT AS n, {r('fp / (fp + tn)', 'false_positive_rate')},
{r('fn / (fn + tp)', 'false_negative_rate')}, {r('(tp + fp) / (tn + fp + fn + tp)', 'predicted_positive_rate')},
{r('(tp + fn) / (tn + fp + fn + tp)', 'actual_positive_rate')} FROM cf""")
def error_rates(spark, folder):
    counts = performance.confusion_counts(scored(spark, folder), "y", "p", 0.2)
    return rounded(performance.threshold_metrics(counts).select(
        "n", "false_positive_rate", "false_negative_rate", "predicted_positive_rate", "actual_positive_rate"))


@query("roc_auc", f"WITH {METRICS_SQL} SELECT {r('auc', 'roc_auc')} FROM rk")
def roc_auc(spark, folder):
    curve = performance.score_curve(scored(spark, folder), "y", "p")
    return rounded(performance.rank_metrics(curve).select("roc_auc"))


@query("average_precision", f"WITH {METRICS_SQL} SELECT {r('ap', 'average_precision')} FROM rk")
def average_precision(spark, folder):
    curve = performance.score_curve(scored(spark, folder), "y", "p")
    return rounded(performance.rank_metrics(curve).select("average_precision"))


@query("evaluate_models", f"""WITH {CANDIDATES_SQL}, cf AS (SELECT l_returnflag || l_linestatus AS model, count(*) AS n,
(count(*) FILTER (late = 0 AND p < 0.5))::DOUBLE AS tn, (count(*) FILTER (late = 0 AND p >= 0.5))::DOUBLE AS fp,
(count(*) FILTER (late = 1 AND p < 0.5))::DOUBLE AS fn, (count(*) FILTER (late = 1 AND p >= 0.5))::DOUBLE AS tp FROM ({SCORED_SQL}) GROUP BY 1)
SELECT model AS Model, n, {r('(tp + tn) / n', 'accuracy')}, {r('tp / (tp + fp)', 'precision')}, {r('tp / (tp + fn)', 'recall')},
{r('2 * tp / (2 * tp + fp + fn)', 'f1')}, {r('auc', 'roc_auc')}, {r('ap', 'average_precision')} FROM cf JOIN rk USING (model)""")
def evaluate_models(spark, folder):
    return rounded(candidates(spark, folder).select("Model", "n", "accuracy", "precision", "recall", "f1", "roc_auc",
                                                    "average_precision"))


_PERF = f"""WITH {METRICS_SQL}, g(metric, floor, gi) AS (VALUES ('Average Precision', 0.15::DOUBLE, 0), ('ROC-AUC', 0.65::DOUBLE, 1),
('Recall', 0.35::DOUBLE, 4), ('Precision', 0.2::DOUBLE, 3), ('F1', 0.25::DOUBLE, 5)),
b(metric, base, bi) AS (VALUES ('Average Precision', 0.31::DOUBLE, 0), ('ROC-AUC', 0.55::DOUBLE, 1), ('Recall', 0.5::DOUBLE, 4)),
l AS (SELECT 0 AS kind, gi AS place, 2 AS rank, printf('below floor: %s %.4f vs floor %.4f', metric, value, floor) AS said
FROM m JOIN g USING (metric) WHERE value < floor UNION ALL SELECT 1, bi, CASE WHEN base - value >= 0.05 THEN 2 ELSE 1 END,
printf('%s fell %.4f below the champion''s test baseline (%s)', metric, base - value,
CASE WHEN base - value >= 0.05 THEN 'critical at 0.05' ELSE 'warning at 0.02' END) FROM m JOIN b USING (metric) WHERE base - value >= 0.02),
st AS (SELECT CASE coalesce(max(rank), 0) WHEN 2 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'stable' END AS status,
coalesce(string_agg(said, '; ' ORDER BY kind, place), 'all gates passed and no material degradation') AS reasons FROM l)"""


@query("performance_report", f"""{_PERF} SELECT true AS labels_available, status, reasons, {r('ap', 'average_precision')},
{r('auc', 'roc_auc')}, {r('tp / (tp + fn)', 'recall')}, {r('(tp + tn) / (tp + tn + fp + fn)', 'accuracy')}, 0.2::DOUBLE AS threshold,
(SELECT string_agg(metric, ',' ORDER BY gi) FROM m JOIN g USING (metric) WHERE value >= floor) AS gates_passed,
(SELECT string_agg(metric, ',' ORDER BY gi) FROM m JOIN g USING (metric) WHERE value < floor) AS gates_failed,
(SELECT string_agg(printf('%s %.6f', metric, value - base), ',' ORDER BY bi) FROM m JOIN b USING (metric)) AS compared
FROM rk, cf, st UNION ALL SELECT false, 'not_available', 'the batch carries no observed outcomes', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL""")
def performance_report(spark, folder):
    df = scored(spark, folder)
    with_labels = performance.performance_report(df, "y", "p", 0.2, baseline=BASELINE)
    without = performance.performance_report(df.drop("y"), "y", "p", 0.2)
    both = with_labels.unionByName(without, allowMissingColumns=True)
    listed = [F.when(F.size(c) > 0, F.array_join(c, ",")).alias(c) for c in ("gates_passed", "gates_failed")]
    compared = F.transform("baseline_comparison", lambda x: F.format_string("%s %.6f", x["metric"], x["change"]))
    return rounded(performance.normalise_status(both).select(
        "labels_available", "status", "reasons", "average_precision", "roc_auc", "recall", "accuracy", "threshold", *listed,
        F.array_join(compared, ",").alias("compared")))


@query("f1_threshold", f"""WITH {METRICS_SQL}, c AS (SELECT p, ctp / (ctp + cfp) AS pr, ctp / (SELECT sum(tp) FROM s) AS rc FROM w),
f AS (SELECT *, 2 * pr * rc / (pr + rc + 1e-12) AS f1 FROM c) SELECT p AS threshold, {r('pr', 'precision')}, {r('rc', 'recall')},
{r('f1', 'f1')} FROM f ORDER BY f.f1 DESC, p LIMIT 1""")
def f1_threshold(spark, folder):
    return rounded(performance.f1_threshold(performance.score_curve(scored(spark, folder), "y", "p")))


_GROUPS = ("l_linestatus", "l_returnflag")
_GROUP_ROWS = f"g AS ({group_sql(SCORED_SQL, _GROUPS, 0.2, 100)})"
_DISPARITY = f"""{_GROUP_ROWS}, d AS (SELECT group_column, count(*) FILTER (status = 'measured') AS groups_measured,
count(*) FILTER (status <> 'measured') AS groups_insufficient, CASE WHEN count(positive_prediction_rate) >= 2 THEN
max(positive_prediction_rate) - min(positive_prediction_rate) END AS demographic_parity_difference,
CASE WHEN count(recall) >= 2 THEN max(recall) - min(recall) END AS equal_opportunity_difference FROM g GROUP BY 1)"""
_LIMITS = {"enabled": True, "minimum_group_size": 100, "max_demographic_parity_difference": 0.001,
           "max_equal_opportunity_difference": 0.01}


def _groups(spark, folder, minimum: int = 100):
    return fairness.group_metrics(scored(spark, folder), list(_GROUPS), "p", 0.2, "y", minimum)


@query("group_metrics", f"WITH h AS ({group_sql(SCORED_SQL, _GROUPS, 0.2, 18000)}) SELECT * FROM h")
def group_metrics(spark, folder):
    return rounded(_groups(spark, folder, 18000))


@query("group_disparity", f"""WITH {_DISPARITY} SELECT * REPLACE ({r('demographic_parity_difference', 'demographic_parity_difference', 5)},
{r('equal_opportunity_difference', 'equal_opportunity_difference', 5)}) FROM d""")
def group_disparity(spark, folder):
    return rounded(fairness.group_disparity(rounded(_groups(spark, folder))), 5)


@query("fairness_report", f"""WITH {_DISPARITY}, l AS (SELECT group_column, concat_ws('; ',
CASE WHEN demographic_parity_difference > 0.001 THEN printf('%s: positive-prediction-rate spread %.3f exceeds 0.001', group_column, demographic_parity_difference) END,
CASE WHEN equal_opportunity_difference > 0.01 THEN printf('%s: recall spread %.3f exceeds 0.01', group_column, equal_opportunity_difference) END) AS said FROM d)
SELECT CASE WHEN max(groups_measured) < 2 THEN 'insufficient_data' WHEN count(*) FILTER (said <> '') > 0 THEN 'warning' ELSE 'stable' END AS status,
coalesce(string_agg(said, '; ' ORDER BY group_column) FILTER (said <> ''), 'all measured disparities within configured limits') AS reasons,
true AS labels_available, 'l_linestatus,l_returnflag' AS columns_used, 'region' AS columns_absent FROM d JOIN l USING (group_column)""")
def fairness_report(spark, folder):
    return fairness.fairness_report(scored(spark, folder), "p", 0.2, _LIMITS, "y", [*_GROUPS, "region"])[0]


@query("fairness_escalate", f"""WITH {_DISPARITY} SELECT CASE WHEN max(demographic_parity_difference) > 0.002 THEN 'critical'
WHEN max(demographic_parity_difference) > 0.001 THEN 'warning' ELSE 'stable' END AS status,
{r('max(demographic_parity_difference)', 'largest', 5)} FROM d""")
def fairness_escalate(spark, folder):
    return rounded(fairness.escalated(fairness.group_disparity(_groups(spark, folder)), 0.001), 5)


_SECTIONS = """SELECT o_orderpriority AS section, CASE WHEN avg(o_totalprice) > 252000 THEN 'warning' WHEN count(*) % 2 = 0 THEN
'insufficient_data' ELSE 'stable' END AS status, row_number() OVER (ORDER BY o_orderpriority) AS position FROM orders GROUP BY 1"""


@query("overall_status", f"""SELECT coalesce((SELECT status FROM ({_SECTIONS}) ORDER BY CASE status WHEN 'warning' THEN 3 WHEN
'insufficient_data' THEN 2 ELSE 0 END DESC, position LIMIT 1), 'not_available') AS overall_status, 5::BIGINT AS sections""")
def overall_status(spark, folder):
    from pyspark.sql import Window

    by = Window.orderBy("section")
    sections = table(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("section")).agg(
        F.expr("CASE WHEN avg(o_totalprice) > 252000 THEN 'warning' WHEN count(1) % 2 = 0 THEN 'insufficient_data' "
               "ELSE 'stable' END").alias("status")).withColumn("position", F.row_number().over(by))
    return status.overall_status(sections)


@query("select_champion", f"""WITH {CANDIDATES_SQL}, b AS (SELECT model, ap, auc FROM rk ORDER BY ap DESC, model LIMIT 1)
SELECT model AS Model, {r('ap', 'average_precision')}, ap >= 0.15 AND auc >= 0.65 AS promoted, concat_ws('; ',
CASE WHEN ap < 0.15 THEN printf('Average Precision=%.4f is below the required 0.15', ap) END,
CASE WHEN auc < 0.65 THEN printf('ROC-AUC=%.4f is below the required 0.65', auc) END) AS failures FROM b""")
def select_champion(spark, folder):
    best = selection.select_champion(candidate_metrics(spark, folder))
    return rounded(best.select("Model", F.col("Average Precision").alias("average_precision"), "promoted",
                               F.concat_ws("; ", "gate_failures").alias("failures")))


@query("promotion", f"""WITH {CANDIDATES_SQL}, cf AS (SELECT l_returnflag || l_linestatus AS model,
(count(*) FILTER (late = 1 AND p >= 0.5)) / (count(*) FILTER (late = 1)) AS rec FROM ({SCORED_SQL}) GROUP BY 1)
SELECT model AS Model, ap >= 0.15 AND auc >= 0.4 AND rec >= 0.1 AS promoted, concat_ws('; ',
CASE WHEN ap < 0.15 THEN printf('Average Precision=%.4f is below the required 0.15', ap) END,
CASE WHEN auc < 0.4 THEN printf('ROC-AUC=%.4f is below the required 0.4', auc) END,
CASE WHEN rec < 0.1 THEN printf('Recall=%.4f is below the required 0.1', rec) END) AS failures FROM rk JOIN cf USING (model)""")
def promotion(spark, folder):
    made = candidate_metrics(spark, folder)
    quality = selection.check_quality_gates(made, {"Average Precision": 0.15, "ROC-AUC": 0.4})
    operational = selection.check_operational_gates(made, {"Recall": 0.1})
    return selection.promotion(quality, operational).withColumn("failures", F.concat_ws("; ", "failures"))
