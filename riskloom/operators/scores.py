"""Score distributions: summaries, classes at a threshold, and drift between two batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import count_if, finite, local_rows, named, sql_finite
from riskloom.functions.distance import bin_index, distances
from riskloom.functions.ranges import quantiles
from riskloom.operators.drift import CRITICAL, DRIFT_LIMITS, STABLE, WARNING, histogram_parts, two_sided
from riskloom.sources.sinks import write_parquet

# The eleven edges of the probability histogram, as floating point yields them.
PROBABILITY_EDGES = [i * 0.1 for i in range(11)]
PREDICTION_LIMITS = {"mean_probability_change_threshold": 0.05, "positive_rate_change_threshold": 0.05}


def threshold_class(score: Column, threshold: float) -> Column:
    """Inclusive: a score equal to the threshold is positive."""
    return (score >= F.lit(float(threshold))).cast("int")


def minmax_scores(df: DataFrame, score: str, output: str = "score_scaled") -> DataFrame:
    """Decision scores onto [0, 1] by the batch's own range; two scalars are fetched first."""
    low, high = df.agg(F.min(named(score).cast("double")), F.max(named(score).cast("double"))).first()
    if low is None:
        return df.withColumn(output, F.lit(None).cast("double"))
    return df.withColumn(output, (named(score) - F.lit(low)) / F.lit(high - low + 1e-12))


def _summaries(df: DataFrame, score: str, threshold: float, sides: Sequence[str]) -> list[dict]:
    """Statistics of the finite scores per side, one aggregation; scores outside [0, 1] are refused."""
    p = F.col("p")
    rows = {r["side"]: r.asDict() for r in df.groupBy("side").agg(
        F.count(F.lit(1)).alias("rows"), F.count(p).alias("n"), F.min(p).alias("min_probability"),
        F.max(p).alias("max_probability"), F.avg(p).alias("mean_probability"),
        F.stddev_pop(p).alias("std_probability"),
        F.avg((p >= F.lit(float(threshold))).cast("double")).alias("positive_rate")).collect()}
    out = []
    for side, name in enumerate(sides):
        seen = rows.get(side)
        if seen is None:
            raise ValueError(f"{name}: no predictions to describe")
        if not seen["n"]:
            raise ValueError(f"{name}: no prediction is finite")
        if seen["min_probability"] < 0.0 or seen["max_probability"] > 1.0:
            raise ValueError(f"{name}: predictions must lie in [0, 1], found "
                             f"[{seen['min_probability']}, {seen['max_probability']}]")
        out.append(seen)
    return out


SUMMARY = ("mean_probability", "std_probability", "min_probability", "max_probability", "positive_rate")


def describe_scores(df: DataFrame, score: str, threshold: float) -> DataFrame:
    """One row: count, mean, median, population deviation, range and positive rate of finite scores."""
    one = df.selectExpr(f"{sql_finite(df, score)} AS p", "0 AS side")
    seen = _summaries(one, score, threshold, [score])[0]
    profile = {"p": {"n": seen["n"], "low": seen["min_probability"], "high": seen["max_probability"]}}
    median = quantiles(one, {"p": [0.5]}, profile)["p"][0]
    values = (seen["n"], *[seen[k] for k in SUMMARY], median, float(threshold))
    return local_rows(df.sparkSession, [values], "n long, " + ", ".join(f"{k} double" for k in (
        *SUMMARY, "median_probability", "threshold")))


def score_histogram(df: DataFrame, score: str, edges: list[float] | None = None) -> DataFrame:
    """Counts per fixed bin, left-closed with the last bin closed; empty bins are rows with 0."""
    edges = edges or PROBABILITY_EDGES
    p = finite(named(score))
    inside = df.select(p.alias("p")).filter((F.col("p") >= edges[0]) & (F.col("p") <= edges[-1]))
    counts = inside.groupBy(F.expr(bin_index("p", edges[1:-1])).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = local_rows(
        df.sparkSession, [(i, edges[i], edges[i + 1]) for i in range(len(edges) - 1)], "bin int, low double, high double")
    return grid.join(counts, "bin", "left").na.fill(0, ["n"])


def paired_histogram(reference: DataFrame, current: DataFrame, score: str) -> DataFrame:
    """``(part, ref, cur, ref_share, cur_share)`` on the fixed probability bins, from one count."""
    parts = histogram_parts(two_sided(reference, current, [score]), {score: PROBABILITY_EDGES})
    whole = Window.partitionBy("feature")
    return parts.select("part", "ref", "cur", *[
        F.try_divide(F.col(c), F.sum(c).over(whole)).alias(f"{c}_share") for c in ("ref", "cur")])


def prediction_drift(reference: DataFrame, current: DataFrame, score: str, threshold: float,
                     limits: Mapping[str, float] = PREDICTION_LIMITS,
                     bands: Mapping[str, float] = DRIFT_LIMITS) -> DataFrame:
    """One row comparing both score distributions at the frozen threshold, with status and reasons.

    Three scans: moments per side; medians and reference deciles together; quantile bins and fixed
    bins together.
    """
    spark = reference.sparkSession
    both = two_sided(reference, current, [score]).select(named(score).alias("p"), "side")
    seen = _summaries(both, score, threshold, ["reference", "current"])
    split = both.selectExpr("CASE WHEN side = 0 THEN p END AS ref", "CASE WHEN side = 1 THEN p END AS cur")
    profile = {k: {"n": s["n"], "low": s["min_probability"], "high": s["max_probability"]}
               for k, s in zip(("ref", "cur"), seen)}
    deciles = [i * 10 / 100 for i in range(11)]
    found = quantiles(split, {"ref": [*deciles, 0.5], "cur": [0.5]}, profile)
    edges = {"quantile": sorted(set(found["ref"][:-1])), "fixed": PROBABILITY_EDGES}
    used = {k: e for k, e in edges.items() if len(e) >= 3}
    parts = histogram_parts(both.selectExpr("p AS quantile", "p AS fixed", "side"), used)
    apart = {r["feature"]: r for r in distances(parts, ["feature"]).collect()}

    return _drift_row(spark, seen, (found["ref"][-1], found["cur"][0]), apart, threshold, limits, bands)


def _drift_row(spark, seen: Sequence[Mapping], medians: Sequence[float], apart: Mapping[str, Mapping], threshold: float,
               limits: Mapping[str, float], bands: Mapping[str, float]) -> DataFrame:
    row: dict[str, float] = {}
    for name, stats, median in zip(("reference", "current"), seen, medians):
        row |= {f"{name}_n": stats["n"], **{f"{name}_{k}": stats[k] for k in SUMMARY}, f"{name}_median_probability": median}
    row["probability_psi"] = apart["quantile"]["psi"] if "quantile" in apart else 0.0
    row["probability_distribution_distance"] = apart["fixed"]["js"]
    for k in ("mean_probability", "median_probability", "std_probability", "positive_rate"):
        row[f"{k}_change"] = row[f"current_{k}"] - row[f"reference_{k}"]
    row["threshold"] = float(threshold)
    schema = ", ".join(f"{k} {'long' if k.endswith('_n') else 'double'}" for k in row)
    return prediction_status(local_rows(spark, [tuple(row.values())], schema), limits, bands)


def prediction_status(df: DataFrame, limits: Mapping[str, float] = PREDICTION_LIMITS,
                      bands: Mapping[str, float] = DRIFT_LIMITS) -> DataFrame:
    value, mean, rate = F.col("probability_psi"), F.col("mean_probability_change"), F.col("positive_rate_change")
    critical, warning = bands["psi_critical_threshold"], bands["psi_warning_threshold"]
    mean_limit = limits["mean_probability_change_threshold"]
    rate_limit = limits["positive_rate_change_threshold"]
    mean_moved, rate_moved = F.abs(mean) >= mean_limit, F.abs(rate) >= rate_limit
    # Fixed formats: the wording of reasons in the prediction report.
    said = F.concat_ws(
        "; ",
        F.when(value >= critical, F.format_string(f"probability PSI %.3f >= critical {critical}", value))
        .when(value >= warning, F.format_string(f"probability PSI %.3f >= warning {warning}", value)),
        F.when(mean_moved, F.format_string(f"mean probability moved %+.4f (limit {mean_limit})", mean)),
        F.when(rate_moved, F.format_string(f"positive rate moved %+.4f (limit {rate_limit})", rate)))
    return df.withColumn("status", F.when(value >= critical, CRITICAL).when(
        (value >= warning) | mean_moved | rate_moved, WARNING).otherwise(STABLE)).withColumn(
        "reasons", F.when(said == "", F.lit("within thresholds")).otherwise(said))


def positive_count(df: DataFrame, score: str, threshold: float) -> DataFrame:
    return df.agg(count_if(named(score) >= F.lit(float(threshold))).alias("positives"))


@dataclass(frozen=True)
class ScoreProfile:
    """What monitoring needs of the reference scores, so that their rows need not be kept or read again: moments and
    rates at the frozen threshold, the median, decile edges, and counts in decile bins and in fixed bins."""

    threshold: float
    stats: dict
    median: float
    edges: list[float]
    counts: dict[str, list[int]]

    @classmethod
    def of(cls, df: DataFrame, score: str, threshold: float) -> ScoreProfile:
        one = df.selectExpr(f"{sql_finite(df, score)} AS p", "0 AS side")
        seen = _summaries(one, score, threshold, ["reference"])[0]
        profile = {"p": {"n": seen["n"], "low": seen["min_probability"], "high": seen["max_probability"]}}
        *deciles, median = quantiles(one, {"p": [*(i * 10 / 100 for i in range(11)), 0.5]}, profile)["p"]
        edges = sorted(set(deciles))
        counts = _bin_counts(one, edges)
        return cls(float(threshold), {k: seen[k] for k in ("n", *SUMMARY)}, median, edges, counts)

    def merged(self, other: ScoreProfile) -> ScoreProfile:
        """With the counts of further scores on the same edges; the edges and the median stay those of the first batch."""
        if (self.threshold, self.edges) != (other.threshold, other.edges):
            raise ValueError("profiles with different thresholds or edges do not add up")
        a, b = self.stats, other.stats
        n = a["n"] + b["n"]
        share = b["n"] / n
        shift = b["mean_probability"] - a["mean_probability"]
        spread = (1 - share) * a["std_probability"] ** 2 + share * b["std_probability"] ** 2 + share * (1 - share) * shift**2
        stats = {"n": n, "mean_probability": a["mean_probability"] + share * shift, "std_probability": spread**0.5,
                 "min_probability": min(a["min_probability"], b["min_probability"]),
                 "max_probability": max(a["max_probability"], b["max_probability"]),
                 "positive_rate": a["positive_rate"] + share * (b["positive_rate"] - a["positive_rate"])}
        counts = {k: [x + y for x, y in zip(v, other.counts[k])] for k, v in self.counts.items()}
        return ScoreProfile(self.threshold, stats, self.median, self.edges, counts)

    def save(self, spark: SparkSession, path: str) -> str:
        row = (self.threshold, self.stats["n"], *(self.stats[k] for k in SUMMARY), self.median, self.edges,
               self.counts.get("quantile", []), self.counts["fixed"])
        return write_parquet(local_rows(spark, [row], _PROFILE_SCHEMA), path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ScoreProfile:
        r = spark.read.parquet(path).first()
        counts = {"fixed": list(r["fixed_counts"])} | ({"quantile": list(r["quantile_counts"])} if r["quantile_counts"] else {})
        return cls(r["threshold"], {k: r[k] for k in ("n", *SUMMARY)}, r["median_probability"], list(r["edges"]), counts)


_PROFILE_SCHEMA = ("threshold double, n long, " + ", ".join(f"{k} double" for k in SUMMARY)
                   + ", median_probability double, edges array<double>, quantile_counts array<long>, fixed_counts array<long>")


def _bin_counts(one: DataFrame, edges: list[float]) -> dict[str, list[int]]:
    """Counts of ``p`` in decile bins (none below three edges) and fixed bins, from one scan."""
    used = {k: e for k, e in {"quantile": edges, "fixed": PROBABILITY_EDGES}.items() if len(e) >= 3}
    counts: dict[str, list[int]] = {k: [0] * (len(e) - 1) for k, e in used.items()}
    for r in histogram_parts(one.selectExpr("p AS quantile", "p AS fixed", "0 AS side"), used).collect():
        counts[r["feature"]][r["part"]] = r["ref"]
    return counts


def prediction_drift_from(profile: ScoreProfile, current: DataFrame, score: str,
                          limits: Mapping[str, float] = PREDICTION_LIMITS,
                          bands: Mapping[str, float] = DRIFT_LIMITS) -> DataFrame:
    """``prediction_drift`` against a stored profile: only the current batch is read."""
    spark = current.sparkSession
    one = current.selectExpr(f"{sql_finite(current, score)} AS p", "0 AS side")
    seen = _summaries(one, score, profile.threshold, ["current"])[0]
    known = {"p": {"n": seen["n"], "low": seen["min_probability"], "high": seen["max_probability"]}}
    median = quantiles(one, {"p": [0.5]}, known)["p"][0]
    now = _bin_counts(one, profile.edges)
    parts = local_rows(spark, [(k, i, ref, now[k][i]) for k, counts in profile.counts.items() for i, ref in enumerate(counts)],
                       "feature string, part int, ref long, cur long")
    apart = {r["feature"]: r for r in distances(parts, ["feature"]).collect()}
    return _drift_row(spark, (profile.stats, seen), (profile.median, median), apart, profile.threshold, limits, bands)
