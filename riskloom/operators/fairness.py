"""Outcome differences between groups. Small groups are reported as such, never merged."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import count_if, flat_map, local_rows, named, share
from riskloom.operators.drift import CRITICAL, INSUFFICIENT, STABLE, WARNING
from riskloom.operators.performance import NOT_AVAILABLE

# Default grouping columns of the credit tables and the configured limits.
GROUP_COLUMNS = ("CODE_GENDER", "NAME_FAMILY_STATUS", "NAME_EDUCATION_TYPE", "NAME_INCOME_TYPE")
FAIRNESS_LIMITS = {
    "enabled": True, "minimum_group_size": 100, "max_demographic_parity_difference": 0.10,
    "max_equal_opportunity_difference": 0.10,
}
MEASURED = "measured"


def group_metrics(df: DataFrame, columns: Sequence[str], score: str, threshold: float, label: str | None = None,
                  minimum: int = 100) -> DataFrame:
    """One row per grouping column and value, from one pass over the table.

    All sums combine map-side, so a group that holds most of the rows costs no more than a rare one.
    """
    p = named(score).cast("double")
    y = named(label).cast("int") if label else F.lit(None).cast("int")
    cells = [F.when(named(c).isNotNull(), F.struct(F.lit(c).alias("group_column"),
                                                   named(c).cast("string").alias("group_value"))) for c in columns]
    rows = flat_map(df, cells, [p.alias("p"), y.alias("y")])
    hit = F.col("p") >= F.lit(float(threshold))
    counted = rows.groupBy("group_column", "group_value").agg(
        F.count(F.lit(1)).alias("n"), F.avg(hit.cast("double")).alias("hits"), F.avg("p").alias("mean"),
        F.avg(F.col("y").cast("double")).alias("positive"), count_if((F.col("y") == 1) & hit).alias("tp"),
        count_if((F.col("y") == 0) & hit).alias("fp"), count_if((F.col("y") == 1) & ~hit).alias("fn"),
        count_if((F.col("y") == 0) & ~hit).alias("tn"))
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    enough = F.col("n") >= minimum
    labelled = enough & F.lit(label is not None)
    return counted.select(
        "group_column", "group_value", "n",
        F.when(enough, F.col("hits")).alias("positive_prediction_rate"),
        F.when(enough, F.col("mean")).alias("mean_probability"),
        F.when(labelled, F.col("positive")).alias("actual_default_rate"),
        F.when(labelled, share(tp, tp + fp, 0.0)).alias("precision"),
        F.when(labelled, share(tp, tp + fn)).alias("recall"),
        F.when(labelled, share(fp, fp + tn, 0.0)).alias("false_positive_rate"),
        F.when(labelled, share(fn, fn + tp)).alias("false_negative_rate"),
        F.when(enough, MEASURED).otherwise(INSUFFICIENT).alias("status"),
        F.when(enough, F.lit("")).otherwise(F.format_string(f"%d rows, minimum {minimum}", "n")).alias("note"))


def group_disparity(groups: DataFrame) -> DataFrame:
    """Largest minus smallest rate over the measured groups of each column; NULL with fewer than two."""
    def spread(c: str):
        x = F.when(F.col("status") == MEASURED, F.col(c))
        return F.when(F.count(x) >= 2, F.max(x) - F.min(x))

    return groups.groupBy("group_column").agg(
        count_if(F.col("status") == MEASURED).alias("groups_measured"),
        count_if(F.col("status") == INSUFFICIENT).alias("groups_insufficient"),
        spread("positive_prediction_rate").alias("demographic_parity_difference"),
        spread("recall").alias("equal_opportunity_difference"))


def fairness_status(disparities: DataFrame, limits: Mapping = FAIRNESS_LIMITS) -> DataFrame:
    """One row ``(status, reasons)`` over all grouping columns."""
    parity, opportunity = F.col("demographic_parity_difference"), F.col("equal_opportunity_difference")
    parity_limit = float(limits["max_demographic_parity_difference"])
    chance_limit = float(limits["max_equal_opportunity_difference"])
    # Fixed formats: the wording of reasons in the group report.
    said = F.concat_ws(
        "; ",
        F.when(parity > parity_limit, F.format_string(
            f"%s: positive-prediction-rate spread %.3f exceeds {parity_limit}", "group_column", parity)),
        F.when(opportunity > chance_limit, F.format_string(
            f"%s: recall spread %.3f exceeds {chance_limit}", "group_column", opportunity)))
    lines = F.array_sort(F.collect_list(F.when(said != "", F.struct("group_column", said.alias("said")))))
    out = disparities.agg(F.coalesce(F.max(F.col("groups_measured") >= 2), F.lit(False)).alias("any"),
                          F.transform(lines, lambda s: s["said"]).alias("lines"))
    none = F.lit("no grouping column had two or more groups above the minimum size")
    spoken = F.when(F.col("any"), F.col("lines")).otherwise(F.concat(F.col("lines"), F.array(none)))
    return out.select(
        F.when(~F.col("any"), INSUFFICIENT).when(F.size("lines") > 0, WARNING).otherwise(STABLE).alias("status"),
        F.when(F.size(spoken) > 0, F.concat_ws("; ", spoken))
        .otherwise(F.lit("all measured disparities within configured limits")).alias("reasons"))


def fairness_report(df: DataFrame, score: str, threshold: float, limits: Mapping = FAIRNESS_LIMITS,
                    label: str | None = None, columns: Sequence[str] = GROUP_COLUMNS
                    ) -> tuple[DataFrame, DataFrame | None]:
    """(one-row status, group table). Absent grouping columns are named, not guessed."""
    spark = df.sparkSession
    schema = "status string, reasons string, labels_available boolean, columns_used string, columns_absent string"
    present, absent = [c for c in columns if c in df.columns], [c for c in columns if c not in df.columns]
    if not limits.get("enabled", True):
        return local_rows(spark, [(NOT_AVAILABLE, "group monitoring is disabled", False, "", "")], schema), None
    if not present:
        return local_rows(spark, [(NOT_AVAILABLE, "none of the grouping columns is present", False, "",
                                       ",".join(absent))], schema), None
    label = label if label and label in df.columns else None
    groups = group_metrics(df, present, score, threshold, label, int(limits["minimum_group_size"]))
    status = fairness_status(group_disparity(groups), limits).select(
        "*", F.lit(label is not None).alias("labels_available"), F.lit(",".join(present)).alias("columns_used"),
        F.lit(",".join(absent)).alias("columns_absent"))
    return status, groups


def escalated(disparities: DataFrame, limit: float, column: str = "demographic_parity_difference") -> DataFrame:
    """Optional: warnings become critical where the spread is more than twice the limit."""
    spread = F.max(column)
    return disparities.agg(F.when(spread > 2 * limit, CRITICAL).when(spread > limit, WARNING).otherwise(STABLE)
                           .alias("status"), spread.alias("largest"))


def comparable_groups(groups: DataFrame, labels_available: bool) -> DataFrame:
    """Rates to show side by side: recall when labelled, else the positive rate, where two groups have it."""
    metric = "recall" if labels_available else "positive_prediction_rate"
    usable = groups.filter((F.col("status") == MEASURED) & F.col(metric).isNotNull())
    pairs = usable.groupBy("group_column").agg(F.count(F.lit(1)).alias("held")).filter("held >= 2").select("group_column")
    return usable.join(pairs, "group_column", "left_semi").select(
        "group_column", "group_value", "n", F.lit(metric).alias("metric"), F.col(metric).alias("value"))
