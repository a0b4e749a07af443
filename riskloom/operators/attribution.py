"""Additive attributions: linear closed form, checks, global ranking, per-row contributors, examples.

A row's attributions are one array column beside its feature values; names live once, on the side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import chunked, count_if, local_rows, named

TOLERANCE = 1e-3  # fixed value: allowed gap between base + attributions and the margin
TOP_N = 10


def background_means(df: DataFrame, columns: Mapping[str, Column] | Sequence[str]) -> dict[str, float]:
    """Mean per feature over the background rows."""
    exprs = columns if isinstance(columns, Mapping) else {c: named(c) for c in columns}
    out: dict[str, float] = {}
    for part in chunked(list(exprs), 100):
        row = df.agg(*[F.avg(exprs[c].cast("double")).alias(f"m{i}") for i, c in enumerate(part)]).first()
        out.update({c: row[f"m{i}"] for i, c in enumerate(part)})
    return out


def linear_margin(values: Sequence[Column], coefficients: Sequence[float], intercept: float) -> Column:
    total = F.lit(float(intercept))
    for x, w in zip(values, coefficients):
        total = total + x * F.lit(float(w))
    return total


def linear_base(coefficients: Sequence[float], means: Sequence[float], intercept: float) -> float:
    return float(intercept) + sum(w * m for w, m in zip(coefficients, means))


def linear_attribution(values: Sequence[Column], coefficients: Sequence[float], means: Sequence[float]) -> Column:
    """coef * (x - background mean) per feature: exact for independent features."""
    return F.array(*[(x - F.lit(float(m))) * F.lit(float(w)) for x, w, m in zip(values, coefficients, means)])


def array_total(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda a, b: a + b)


def additivity(df: DataFrame, attribution: str, base: Column, margin: str, tolerance: float = TOLERANCE) -> DataFrame:
    """Largest gap between base + attributions and the model's own margin; recorded, not enforced."""
    gap = F.max(F.abs(base + array_total(named(attribution)) - named(margin)))
    return df.agg(gap.alias("max_abs_error")).select(
        "max_abs_error", F.lit(tolerance).alias("tolerance"), (F.col("max_abs_error") <= tolerance).alias("passed"))


def check_attribution(df: DataFrame, attribution: str, features: int) -> DataFrame:
    """Counts of rows with a wrong width or a value that is not finite."""
    a = named(attribution)
    odd = F.exists(a, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  count_if(a.isNull() | (F.size(a) != features)).alias("wrong_width"),
                  count_if(odd).alias("not_finite"))


def mean_absolute(df: DataFrame, attribution: str, names: Sequence[str]) -> DataFrame:
    """Mean absolute attribution per feature, in chunks of plain sums rather than an unpivot."""
    a = named(attribution)
    frames = []
    for start in range(0, len(names), 100):
        part = list(names)[start:start + 100]
        row = df.agg(*[F.avg(F.abs(a[start + i])).alias(f"v{i}") for i in range(len(part))])
        frames.append(row.select(F.inline(F.array(*[
            F.struct(F.lit(start + i).alias("position"), F.lit(n).alias("feature"), F.col(f"v{i}").alias("mean_abs"))
            for i, n in enumerate(part)]))))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def importance(df: DataFrame, attribution: str, names: Sequence[str]) -> DataFrame:
    """Features ranked by mean absolute attribution; equal ones keep their order."""
    order = Window.orderBy(F.col("mean_abs").desc(), F.col("position"))  # one row per feature
    return mean_absolute(df, attribution, names).withColumn("rank", F.row_number().over(order)).select(
        "feature", "mean_abs", "rank")


def contributors(attribution: Column, values: Column, names: Sequence[str], positive: bool, top_n: int = TOP_N) -> Column:
    """The strongest contributions of one sign, strongest first, sorted inside the row."""
    cells = F.zip_with(attribution, values, lambda a, v: F.struct(a.alias("attribution"), v.alias("feature_value")))
    listed = F.transform(cells, lambda s, i: F.struct(
        (-F.abs(s["attribution"])).alias("size"), i.alias("position"),
        F.element_at(F.array(*[F.lit(n) for n in names]), i + 1).alias("feature"),
        s["feature_value"].alias("feature_value"), s["attribution"].alias("attribution")))
    signed = F.filter(listed, lambda s: s["attribution"] > 0 if positive else s["attribution"] < 0)
    return F.transform(F.slice(F.array_sort(signed), 1, top_n), lambda s: F.struct(
        s["feature"].alias("feature"), s["feature_value"].alias("feature_value"), s["attribution"].alias("attribution")))


def explain_rows(df: DataFrame, attribution: str, values: str, names: Sequence[str], top_n: int = TOP_N) -> DataFrame:
    a, v = named(attribution), named(values)
    return df.withColumn("top_positive", contributors(a, v, names, True, top_n)).withColumn(
        "top_negative", contributors(a, v, names, False, top_n)).withColumn("attribution_total", array_total(a))


def contributor_rows(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Explained rows as ``(keep, direction, place, feature, feature_value, attribution)``."""
    def side(column: str, direction: str) -> DataFrame:
        return df.select(*[named(k) for k in keep], F.lit(direction).alias("direction"),
                         F.posexplode(column).alias("place", "c")).select(
            *[named(k) for k in keep], "direction", (F.col("place") + 1).alias("place"), "c.*")
    return side("top_positive", "up").unionByName(side("top_negative", "down"))


def local_examples(df: DataFrame, key: str, score: str, threshold: float, n: int = 5, label: str | None = None
                   ) -> DataFrame:
    """``(position, reason, id)``: extremes, the row nearest the threshold, best hit and worst miss.

    One aggregation keeps a single candidate per reason; rows repeated under a later reason give way
    to the next highest scores. Ties go to the smallest id.
    """
    p, i = named(score), named(key)
    hit = p >= F.lit(float(threshold))
    up = F.struct(-p, i)
    plan = {"highest_risk": F.min_by(i, up), "lowest_risk": F.min_by(i, F.struct(p, i)),
            "nearest_threshold": F.min_by(i, F.struct(F.abs(p - F.lit(float(threshold))), i))}
    if label is not None:
        y = named(label) == 1
        plan["true_positive"] = F.min_by(i, F.when(y & hit, up))
        plan["false_negative"] = F.min_by(i, F.when(y & ~hit, up))
    row = df.agg(*[e.alias(k) for k, e in plan.items()]).first()
    picked: dict = {}
    for reason in plan:
        if row[reason] is not None and row[reason] not in picked.values() and len(picked) < n:
            picked[reason] = row[reason]
    if len(picked) < n:
        more = df.filter(~i.isin(list(picked.values()))).orderBy(p.desc(), i).limit(n - len(picked)).select(i).collect()
        for r in more:
            picked[f"high_risk_{len(picked)}"] = r[0]
    kind = df.schema[key].dataType.simpleString()
    return local_rows(df.sparkSession, [(j, k, v) for j, (k, v) in enumerate(picked.items())],
                                           f"position int, reason string, `{key}` {kind}")
