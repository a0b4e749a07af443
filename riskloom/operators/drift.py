"""Feature drift between a reference and a current batch, over all rows of both.

Wide aggregations give moments and missing rates; quantile edges come from exact order statistics;
binning both sides is one map-side combined count; the KS distance refines only value ranges that
can still hold the maximum. What reaches the driver is bounded by the number of features.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import (
    AnalysisException, ArithmeticException, ArrayIndexOutOfBoundsException, DateTimeException, IllegalArgumentException,
    NumberFormatException, SparkRuntimeException)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.columns import (
    category_cells, chunked, count_if, flat_map, local_rows, named, quoted, sql_finite, sql_missing, sql_string)
from riskloom.functions.distance import distances
from riskloom.functions.ranges import COLUMNS_PER_SCAN, largest_gaps, locate, paired_profile, quantiles

log = logging.getLogger(__name__)

# Statuses with their severity, and the floors below which a signal is ignored.
STABLE, WARNING, CRITICAL = "stable", "warning", "critical"
INSUFFICIENT, ERROR = "insufficient_data", "error"
SEVERITY = {STABLE: 0, INSUFFICIENT: 1, ERROR: 1, WARNING: 2, CRITICAL: 3}
MIN_ROWS = 30
MIN_KS_EFFECT = 0.05
MIN_UNSEEN_RATE = 0.005
MIN_MISSING_CHANGE = 0.05
DRIFT_LIMITS = {"psi_warning_threshold": 0.10, "psi_critical_threshold": 0.25, "ks_pvalue_threshold": 0.05}
MAX_DRIFTED_RATIO = 0.20

MEASURES = {
    "feature": "string", "feature_type": "string", "psi": "double", "ks_statistic": "double", "ks_pvalue": "double",
    "distribution_distance": "double", "total_variation_distance": "double", "unseen_category_rate": "double",
    "reference_missing_rate": "double", "current_missing_rate": "double", "missing_rate_change": "double",
    "reference_mean": "double", "current_mean": "double", "reference_std": "double", "current_std": "double",
    "reference_n": "long", "current_n": "long", "reference_categories": "long", "current_categories": "long",
}


def two_sided(reference: DataFrame, current: DataFrame, columns: Sequence[str], numeric: bool = True,
              side: str = "side") -> DataFrame:
    """Both batches below each other, marked 0 and 1, pruned to the compared columns."""
    def part(df: DataFrame, mark: int) -> DataFrame:
        return df.selectExpr(*[f"{sql_finite(df, c) if numeric else f'CAST({quoted(c)} AS STRING)'} AS {quoted(c)}"
                               for c in columns], f"{mark} AS {side}")
    return part(reference, 0).unionByName(part(current, 1))


def quantile_edges(df: DataFrame, columns: Sequence[str], buckets: int = 10, profile: Mapping[str, dict] | None = None
                   ) -> dict[str, list[float]]:
    """Distinct exact quantile edges 0, 1/buckets, ..., 1 of each column."""
    levels = [i * (100 / buckets) / 100 for i in range(buckets + 1)]
    wanted = quantiles(df, {c: levels for c in columns}, profile)
    return {c: sorted({v for v in values if v is not None}) for c, values in wanted.items()}


def histogram_parts(both: DataFrame, edges: Mapping[str, Sequence[float]], side: str = "side") -> DataFrame:
    """``(feature, part, ref, cur)`` with every bin present; the outer bins are open-ended.

    One combined count over both batches. Its result is as small as features x bins, so it comes
    back as a local table and nothing that uses it scans the batches again.
    """
    names = list(edges)
    found: dict[tuple[str, int], tuple[int, int]] = {}
    for part in chunked(names, COLUMNS_PER_SCAN):
        base = both.select(*[named(c).cast("double").alias(f"x{i}") for i, c in enumerate(part)], named(side).alias("side"))
        # a binary search: a comparison for each edge of each column is more code than the JVM compiles
        base = locate(base, {f"x{i}": edges[c][1:-1] for i, c in enumerate(part)}, "_at")
        cells = [F.expr(f"CASE WHEN x{i} IS NOT NULL THEN named_struct('feature', {sql_string(c)}, 'part', x{i}_at) END")
                 for i, c in enumerate(part)]
        for r in flat_map(base, cells, [F.col("side")]).groupBy("feature", "part").agg(
                count_if(F.col("side") == 0).alias("ref"), count_if(F.col("side") == 1).alias("cur")).collect():
            found[r["feature"], r["part"]] = (r["ref"], r["cur"])
    rows = [(c, b, *found.get((c, b), (0, 0))) for c in names for b in range(len(edges[c]) - 1)]
    return local_rows(both.sparkSession, rows, "feature string, part int, ref long, cur long")


def psi(reference: DataFrame, current: DataFrame, columns: Sequence[str], buckets: int = 10,
        profile: Mapping[str, dict] | None = None) -> DataFrame:
    """PSI and Jensen-Shannon distance on the reference's own quantile bins, one row per column.

    A column with fewer than three distinct edges has no bins to move between: both are 0.
    """
    edges = quantile_edges(reference, columns, buckets, profile)
    binned = {c: e for c, e in edges.items() if len(e) >= 3}
    parts = histogram_parts(two_sided(reference, current, list(binned)), binned) if binned else None
    return binned_distances(reference, edges, parts)


def binned_distances(df: DataFrame, edges: Mapping[str, Sequence[float]], parts: DataFrame | None) -> DataFrame:
    flat = [(c, 0.0, 0.0) for c, e in edges.items() if 0 < len(e) < 3]
    empty = [(c, None, None) for c, e in edges.items() if not e]
    out = local_rows(df.sparkSession, flat + empty, "feature string, psi double, js double")
    return out if parts is None else out.unionByName(distances(parts, ["feature"]).select("feature", "psi", "js"))


def ks_pvalue(statistic: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample p-value (Kolmogorov series with the usual finite-size correction)."""
    effective = F.sqrt(F.try_divide(n.cast("double") * m.cast("double"), n + m))
    lam = (effective + 0.12 + F.try_divide(F.lit(0.11), effective)) * statistic
    terms = F.transform(F.sequence(F.lit(1), F.lit(100)), lambda k: F.when(k % 2 == 1, 2.0).otherwise(-2.0)
                        * F.exp(-2.0 * k * k * lam * lam))
    series = F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)
    small = F.lit(2.2250738585072014e-308)  # smallest normal double; below it digits are meaningless
    return F.when(lam < 0.2, F.lit(1.0)).when(series < small, F.lit(0.0)).otherwise(F.least(series, F.lit(1.0)))


def _pooled(ref: Mapping[str, dict], cur: Mapping[str, dict], columns: Sequence[str]) -> dict[str, dict]:
    return {c: {"n": ref[c]["n"] + cur[c]["n"], "n_ref": ref[c]["n"], "n_cur": cur[c]["n"],
                "low": min(ref[c]["low"], cur[c]["low"]), "high": max(ref[c]["high"], cur[c]["high"])} for c in columns}


def ks_statistics(reference: DataFrame, current: DataFrame, columns: Sequence[str],
                  ref_profile: Mapping[str, dict] | None = None, cur_profile: Mapping[str, dict] | None = None) -> dict[str, float | None]:
    """Exact two-sample KS distance; ``None`` below the minimum of rows on either side."""
    if ref_profile is None or cur_profile is None:
        ref_profile, cur_profile = paired_profile(reference, current, columns, moments=False)
    ref, cur = ref_profile, cur_profile
    usable = [c for c in columns if min(ref[c]["n"], cur[c]["n"]) >= MIN_ROWS]
    gaps = largest_gaps(two_sided(reference, current, usable), usable, "side", _pooled(ref, cur, usable)) if usable else {}
    return {c: gaps.get(c) for c in columns}


def _missing_rate(p: Mapping) -> float | None:
    return p["missing"] / p["rows"] if p["rows"] else None


def numeric_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str], buckets: int = 10) -> DataFrame:
    ref, cur = paired_profile(reference, current, columns)
    measured = [c for c in columns if min(ref[c]["n"], cur[c]["n"]) >= MIN_ROWS]
    side_by_side = inheritable_thread_target(reference.sparkSession)
    with ThreadPool(2) as pool:  # two independent chains of small jobs
        walking = pool.apply_async(side_by_side(lambda: ks_statistics(reference, current, columns, ref, cur)))
        binning = pool.apply_async(side_by_side(
            lambda: psi(reference, current, measured, buckets, ref) if measured else None))
        gaps, moved = walking.get(), binning.get()
    rows = []
    for c in columns:
        before, after = _missing_rate(ref[c]), _missing_rate(cur[c])
        change = None if before is None or after is None else after - before
        rows.append((c, "numeric", gaps[c], before, after, change, ref[c]["mean"], cur[c]["mean"], ref[c]["std"],
                     cur[c]["std"], ref[c]["n"], cur[c]["n"]))
    stats = local_rows(reference.sparkSession, rows, ", ".join(f"{k} {MEASURES[k]}" for k in (
        "feature", "feature_type", "ks_statistic", "reference_missing_rate", "current_missing_rate",
        "missing_rate_change", "reference_mean", "current_mean", "reference_std", "current_std", "reference_n",
        "current_n")))
    if moved is not None:
        stats = stats.join(moved.withColumnRenamed("js", "distribution_distance"), "feature", "left")
    return _all_measures(stats.withColumn(
        "ks_pvalue", ks_pvalue(F.col("ks_statistic"), F.col("reference_n"), F.col("current_n"))))


def category_counts(reference: DataFrame, current: DataFrame, columns: Sequence[str], keep_missing: bool = False
                    ) -> DataFrame:
    """``(feature, part, ref, cur)`` over the union of both batches' categories.

    ``keep_missing`` keeps a NULL part per feature, so that missing rates need no scan of their own.
    """
    both = two_sided(reference, current, columns, numeric=False)
    counts = flat_map(both, category_cells(columns, value="part", keep_missing=keep_missing), [F.col("side")])
    return counts.groupBy("feature", "part").agg(
        count_if(F.col("side") == 0).alias("ref"), count_if(F.col("side") == 1).alias("cur"))


def category_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Normalised frequencies per column; totals join back, so no window spans a whole column."""
    counts = flat_map(df, category_cells(columns)).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy("feature").agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total), "feature").select(  # one row per column
        "feature", "value", "n", (F.col("n") / F.col("total")).alias("share"))


def _category_summary() -> dict[str, Column]:
    """Aggregates over the known categories of a feature; the NULL part holds the missing rows."""
    known = F.col("part").isNotNull()
    ref, cur = (F.coalesce(F.sum(F.when(known, F.col(c))), F.lit(0)) for c in ("ref", "cur"))
    unseen = F.sum(F.when(known & (F.col("ref") == 0), F.col("cur")).otherwise(0))
    return {"unseen_category_rate": F.when(ref > 0, F.try_divide(unseen, cur)), "reference_n": ref, "current_n": cur,
            "reference_categories": count_if(known & (F.col("ref") > 0)),
            "current_categories": count_if(known & (F.col("cur") > 0))}


def unseen_rates(counts: DataFrame) -> DataFrame:
    """Share of current rows whose category never occurs in the reference."""
    return counts.groupBy("feature").agg(*[e.alias(name) for name, e in _category_summary().items()])


def missing_change(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing rates of both batches and their difference, one row per column, one scan per batch."""
    def rates(df: DataFrame, name: str) -> DataFrame:
        cells = ", ".join(f"named_struct('feature', {sql_string(c)}, '{name}', s{i})" for i, c in enumerate(columns))
        return df.selectExpr(*[f"avg(CAST({sql_missing(df, c)} AS DOUBLE)) AS s{i}" for i, c in enumerate(columns)]
                             ).selectExpr(f"inline(array({cells}))")
    before, after = rates(reference, "reference_missing_rate"), rates(current, "current_missing_rate")
    return before.join(after, "feature").withColumn(
        "missing_rate_change", F.col("current_missing_rate") - F.col("reference_missing_rate"))


def categorical_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One scan of both batches and one shuffle of category counts."""
    counts = category_counts(reference, current, columns, keep_missing=True)
    gone = {c: F.coalesce(F.sum(F.when(F.col("part").isNull(), F.col(c))), F.lit(0)) for c in ("ref", "cur")}
    out = distances(counts, ["feature"], normalise_first=True, extra={
        **_category_summary(), "reference_missing_rate": F.try_divide(gone["ref"], F.sum("ref")),
        "current_missing_rate": F.try_divide(gone["cur"], F.sum("cur"))})
    return _all_measures(out.withColumnsRenamed({"js": "distribution_distance", "tv": "total_variation_distance"})
                         .withColumn("feature_type", F.lit("categorical")).withColumn(
        "missing_rate_change", F.col("current_missing_rate") - F.col("reference_missing_rate")))


def _all_measures(df: DataFrame) -> DataFrame:
    have = set(df.columns)
    return df.select(*[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in MEASURES.items()])


def classified(df: DataFrame, limits: Mapping[str, float] = DRIFT_LIMITS) -> DataFrame:
    """Status and reason. PSI decides; KS needs effect size as well and never makes a critical."""
    value = F.col("psi")
    critical, warning = limits["psi_critical_threshold"], limits["psi_warning_threshold"]
    unusable = F.coalesce(F.col("reference_n"), F.lit(0)), F.coalesce(F.col("current_n"), F.lit(0))
    few = (unusable[0] < MIN_ROWS) | (unusable[1] < MIN_ROWS)
    unknown = value.isNull() | F.isnan(value)
    ks = (F.col("ks_pvalue") < limits["ks_pvalue_threshold"]) & (F.col("ks_statistic") >= MIN_KS_EFFECT)
    unseen = F.col("unseen_category_rate") >= MIN_UNSEEN_RATE
    moved = F.abs(F.col("missing_rate_change")) >= MIN_MISSING_CHANGE
    lifted = F.coalesce(ks, F.lit(False)) | F.coalesce(unseen, F.lit(False)) | F.coalesce(moved, F.lit(False))
    status = (F.when(few | unknown, INSUFFICIENT).when(value >= critical, CRITICAL)
              .when((value >= warning) | lifted, WARNING).otherwise(STABLE))
    # Fixed formats: the wording of reasons in the drift table.
    said = F.concat_ws(
        "; ",
        F.when(value >= critical, F.format_string(f"PSI %.3f >= critical {critical}", value))
        .when(value >= warning, F.format_string(f"PSI %.3f >= warning {warning}", value)),
        F.when(ks, F.format_string("KS statistic %.3f (p=%.2e)", F.col("ks_statistic"), F.col("ks_pvalue"))),
        F.when(unseen, F.format_string("%.1f%% of rows carry categories absent from reference",
                                       F.col("unseen_category_rate") * 100)),
        F.when(moved, F.format_string("missing rate moved %+.1f%%", F.col("missing_rate_change") * 100)))
    reason = (F.when(few, F.format_string(f"fewer than {MIN_ROWS} usable rows (reference %d, current %d)", *unusable))
              .when(unknown, F.lit("PSI could not be computed"))
              .when(said != "", said).otherwise(F.lit("within thresholds")))
    return df.withColumn("drift_status", status).withColumn("drift_reason", reason)


def severity(status: Column) -> Column:
    out = F.lit(0)
    for name, rank in SEVERITY.items():
        out = F.when(status == name, F.lit(rank)).otherwise(out)
    return out


def ordered(report: DataFrame) -> DataFrame:
    """Most drifted first; equal features keep the order in which they were given."""
    return report.orderBy(severity(F.col("drift_status")).desc(), F.col("psi").desc_nulls_last(), F.col("position"))


# What a column's own values or type can cause. Anything else, such as a lost executor, is no property of a feature.
DATA_ERRORS = (AnalysisException, ArithmeticException, ArrayIndexOutOfBoundsException, DateTimeException,
               IllegalArgumentException, NumberFormatException, SparkRuntimeException)


def data_error(error: Exception) -> bool:
    """Several stages that fail at once come as one error that carries theirs."""
    if isinstance(error, DATA_ERRORS):
        return True
    inner = list(error.java_exception.getSuppressed()) if isinstance(error, Py4JJavaError) else []
    names = {kind.__name__.removeprefix("Spark") for kind in DATA_ERRORS}
    return bool(inner) and all(e.getClass().getSimpleName().removeprefix("Spark") in names for e in inner)


def _isolated(measure, reference: DataFrame, current: DataFrame, columns: Sequence[str], kind: str,
              limits: Mapping[str, float]) -> list[DataFrame]:
    """Measure columns in chunks, to the end; a chunk whose data fail is retried in halves, other errors are raised."""
    if not columns:
        return []
    try:
        made = classified(measure(reference, current, columns), limits)
        return [local_rows(reference.sparkSession, [tuple(r) for r in made.collect()], made.schema)]  # a row per feature
    except Exception as error:
        if not data_error(error):
            raise
        if len(columns) > 1:
            half = len(columns) // 2
            return [r for part in (columns[:half], columns[half:])
                    for r in _isolated(measure, reference, current, part, kind, limits)]
        log.warning("no drift for %s: %s", columns[0], error)
        return [_stated(reference, columns[0], kind, ERROR, f"{type(error).__name__}: {str(error).splitlines()[0]}")]


def _stated(df: DataFrame, feature: str, kind: str, status: str, reason: str) -> DataFrame:
    row = local_rows(df.sparkSession, [(feature, kind, status, reason)],
                                          "feature string, feature_type string, drift_status string, drift_reason string")
    return _all_measures(row).join(row.select("feature", "drift_status", "drift_reason"), "feature")


def drift_report(reference: DataFrame, current: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                 limits: Mapping[str, float] = DRIFT_LIMITS, buckets: int = 10) -> DataFrame:
    """One row per feature, unsorted, with ``position``; sort for reading with :func:`ordered`."""
    here = set(reference.columns) & set(current.columns)
    parts: list[DataFrame] = []
    for part in chunked([c for c in numeric if c in here], COLUMNS_PER_SCAN):
        parts += _isolated(lambda r, c, cols: numeric_drift(r, c, cols, buckets), reference, current, part, "numeric",
                           limits)
    for part in chunked([c for c in categorical if c in here], COLUMNS_PER_SCAN):
        parts += _isolated(categorical_drift, reference, current, part, "categorical", limits)
    parts += [_stated(reference, c, kind, INSUFFICIENT, "absent from reference or current batch")
              for kind, cols in (("numeric", numeric), ("categorical", categorical)) for c in cols if c not in here]
    place = local_rows(
        reference.sparkSession, [(c, i) for i, c in enumerate([*numeric, *categorical])], "feature string, position int")
    return reduce(DataFrame.unionByName, parts).join(place, "feature")


def summarise(report: DataFrame, max_drifted_ratio: float = MAX_DRIFTED_RATIO) -> DataFrame:
    """One row of counts per status, the drifted share and the overall status."""
    counted = report.agg(
        F.count(F.lit(1)).alias("monitored_features"),
        *[count_if(F.col("drift_status") == s).alias(f"{n}_features") for n, s in (
            ("stable", STABLE), ("warning", WARNING), ("critical", CRITICAL), ("insufficient", INSUFFICIENT),
            ("error", ERROR))])
    share = F.coalesce(F.try_divide(F.col("critical_features") + F.col("warning_features"),
                                    F.col("monitored_features")), F.lit(0.0))
    return counted.withColumn("drifted_feature_ratio", share).withColumn(
        "max_drifted_feature_ratio", F.lit(float(max_drifted_ratio))).withColumn(
        "status", F.when((F.col("critical_features") > 0) | (share > max_drifted_ratio), CRITICAL)
        .when(F.col("warning_features") > 0, WARNING).otherwise(STABLE))


def top_drifted(report: DataFrame, n: int = 10) -> DataFrame:
    return ordered(report).limit(n).select("feature", "feature_type", "psi", "drift_status", "drift_reason")


def missing_movers(report: DataFrame, n: int = 20) -> DataFrame:
    """Features whose missing rate moved most; unmoved ones are left out."""
    size = F.abs(F.col("missing_rate_change"))
    return report.filter(size > 0).orderBy(size.desc(), "feature").limit(n).select("feature", "missing_rate_change")


def batch_intake(batch: DataFrame, key: str, label: str, sample: int | None = None, seed: int = 42
                 ) -> tuple[DataFrame, bool]:
    """(batch, labelled?). An absent label column means no-label mode and is never filled in."""
    from riskloom.operators.sampling import sample_rows

    return (batch if sample is None else sample_rows(batch, key, sample, seed)), label in batch.columns


def _comparable(df: DataFrame, c: str) -> Column:
    """A form of a column that hashing tells apart exactly: nested values as text, in which nulls keep their place."""
    kind = df.schema[c].dataType
    if isinstance(kind, T.MapType):
        return F.to_json(F.struct(F.array_sort(F.map_entries(named(c))).alias("c")), {"ignoreNullFields": "false"})
    nested = isinstance(kind, (T.ArrayType, T.StructType))
    return F.to_json(F.struct(named(c).alias("c")), {"ignoreNullFields": "false"}) if nested else named(c)


def _digests(df: DataFrame) -> tuple[Column, Column]:
    """128 bits of a row, of which the first half serves as a fingerprint."""
    cells = [_comparable(df, c) for c in df.columns]
    nulls = F.concat(*[F.when(named(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in df.columns])
    return F.xxhash64(nulls, *cells), F.xxhash64(F.lit("second"), *cells, nulls)


def _fingerprint(df: DataFrame) -> tuple:
    """Row count and two order-free digests of all rows, from one narrow aggregation."""
    return tuple(df.select(_digests(df)[0].alias("h")).agg(
        F.count(F.lit(1)), F.bit_xor("h"), F.sum(F.col("h").cast("decimal(20,0)"))).first())


def row_count_differences(reference: DataFrame, current: DataFrame) -> DataFrame:
    """``(h1, h2, n)``: digests of rows that one batch holds ``n`` times more often (reference positive). One exchange of
    digests and counts, combined before it; whole rows never move. The union brings both batches to common types."""
    both = reference.withColumn("__side", F.lit(1)).unionByName(current.withColumn("__side", F.lit(-1)))
    first, second = _digests(both.drop("__side"))
    return both.select(first.alias("h1"), second.alias("h2"), "__side").groupBy("h1", "h2").agg(F.sum("__side").alias("n")).filter("n <> 0")


def batches_identical(reference: DataFrame, current: DataFrame) -> bool:
    """Same rows the same number of times, rows told apart by 128 bits.

    Different fingerprints prove a difference without any shuffle; counts are compared digest by digest only when the
    fingerprints agree, or when the column types differ and they would not be comparable.
    """
    if set(reference.columns) != set(current.columns):
        return False
    current = current.select(*[named(c) for c in reference.columns])
    if reference.dtypes == current.dtypes and _fingerprint(reference) != _fingerprint(current):
        return False
    return row_count_differences(reference, current).isEmpty()
