"""Feature drift, prediction drift and what follows from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.aggregates import COUNTS_SQL, EDGES
from catalog.inputs import BATCHES_SQL, CATEGORICAL, NUMERIC, SCORED_SQL, batches, rated, scored
from catalog.registry import query, r, rounded, table
from riskloom.functions.columns import local_rows
from riskloom.functions.distance import distances
from riskloom.operators import drift, scores
from riskloom.session import shared_folder

_LEVELS = "[0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]"


def distance_sql(parts: str, keys: str = "feature", shares: bool = False) -> str:
    """psi, js, tv per key out of rows (key, ref, cur) of a named relation."""
    p, q = ("(x.ref / rt + 1e-8) / (1 + k * 1e-8)", "(x.cur / ct + 1e-8) / (1 + k * 1e-8)") if shares else (
        "(x.ref + 1e-8) / (rt + k * 1e-8)", "(x.cur + 1e-8) / (ct + k * 1e-8)")
    return f"""SELECT {keys}, sum((q - p) * ln(q / p)) AS psi, sqrt(greatest(sum((p * log2(2 * p / (p + q)) +
    q * log2(2 * q / (p + q))) / 2), 0)) AS js, sum(abs(rp - cp)) / 2 AS tv FROM (SELECT x.{keys}, {p} AS p, {q} AS q,
    x.ref / rt AS rp, x.cur / ct AS cp FROM {parts} x JOIN (SELECT {keys}, sum(ref)::DOUBLE AS rt, sum(cur)::DOUBLE AS ct,
    count(*) AS k FROM {parts} GROUP BY 1) t ON t.{keys} = x.{keys}) GROUP BY 1"""


def binned_sql(columns: list[str]) -> str:
    """CTEs e (edges) and h (feature, bin, ref, cur) on the reference's quantile bins."""
    edges = " UNION ALL ".join(f"SELECT '{c}' AS feature, list_sort(list_distinct(quantile_cont({c}, {_LEVELS}))) AS e FROM ref"
                               for c in columns)
    rows = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c}::DOUBLE AS x, {s} AS side FROM {t} WHERE {c} IS NOT NULL"
                              for c in columns for s, t in ((0, "ref"), (1, "cur")))
    return f"""e AS ({edges}), long AS ({rows}), g AS (SELECT feature, unnest(range(0, len(e) - 1)) AS bin FROM e WHERE len(e) >= 3),
    c AS (SELECT long.feature, len(list_filter(e[2:len(e) - 1], lambda v: v <= x)) AS bin, count(*) FILTER (side = 0) AS ref,
    count(*) FILTER (side = 1) AS cur FROM long JOIN e ON e.feature = long.feature WHERE len(e) >= 3 GROUP BY 1, 2),
    h AS (SELECT g.feature, g.bin, coalesce(ref, 0) AS ref, coalesce(cur, 0) AS cur FROM g LEFT JOIN c
    ON c.feature = g.feature AND c.bin = g.bin),
    d AS ({distance_sql('h')}), nd AS (SELECT e.feature, CASE WHEN len(e) < 3 THEN 0 ELSE psi END AS psi,
    CASE WHEN len(e) < 3 THEN 0 ELSE js END AS js FROM e LEFT JOIN d ON d.feature = e.feature)"""


@query("psi_numeric", f"WITH {BATCHES_SQL}, {binned_sql(NUMERIC)} SELECT feature, {r('psi', 'psi')}, {r('js', 'js')} FROM nd")
def psi_numeric(spark, folder):
    return rounded(drift.psi(*batches(spark, folder), NUMERIC))


_FIXED = f"""e AS (SELECT {EDGES} AS e), b AS (SELECT least(len(list_filter(e, lambda v: v <= p)) - 1, 9) AS bin, late
FROM ({SCORED_SQL}), e), h AS (SELECT 'score' AS feature, g.bin, count(late) FILTER (late = 0) AS ref, count(late) FILTER (late = 1) AS cur
FROM (SELECT unnest(range(0, 10)) AS bin) g LEFT JOIN b ON b.bin = g.bin GROUP BY 1, 2)"""


def _score_sides(spark, folder):
    df = scored(spark, folder)
    return df.filter("late = 0"), df.filter("late = 1").withColumn("p", F.round(F.col("p") * F.col("p"), 4))


@query("js_distance", f"WITH {_FIXED} SELECT feature, {r('js', 'js')} FROM ({distance_sql('h')})")
def js_distance(spark, folder):
    df = scored(spark, folder).withColumnRenamed("p", "score")
    both = drift.two_sided(df.filter("late = 0"), df.filter("late = 1"), ["score"])
    parts = drift.histogram_parts(both, {"score": scores.PROBABILITY_EDGES})
    return rounded(distances(parts, ["feature"]).select("feature", "js"))


@query("score_histograms", f"""WITH {_FIXED} SELECT bin::BIGINT AS part, ref, cur, {r('ref / sum(ref) OVER ()', 'ref_share')},
{r('cur / sum(cur) OVER ()', 'cur_share')} FROM h""")
def score_histograms(spark, folder):
    df = scored(spark, folder)
    return rounded(scores.paired_histogram(df.filter("late = 0"), df.filter("late = 1"), "p"))


@query("tv_distance", f"WITH {BATCHES_SQL}, {COUNTS_SQL} SELECT feature, {r('tv', 'tv')} FROM ({distance_sql('k', shares=True)})")
def tv_distance(spark, folder):
    counts = drift.category_counts(*batches(spark, folder), CATEGORICAL)
    return rounded(distances(counts, ["feature"], normalise_first=True).select("feature", "tv"))


def ks_sql(columns: list[str], long: str = "long") -> str:
    return f"""kc AS (SELECT feature, x, count(*) FILTER (side = 0) AS a, count(*) FILTER (side = 1) AS b FROM {long} GROUP BY 1, 2),
    kw AS (SELECT feature, sum(a) OVER w / sum(a) OVER (PARTITION BY feature) AS fa, sum(b) OVER w / sum(b) OVER (PARTITION BY feature) AS fb
    FROM kc WINDOW w AS (PARTITION BY feature ORDER BY x)), ks AS (SELECT feature, max(abs(fa - fb)) AS ks FROM kw GROUP BY 1)"""


@query("ks_statistic", f"WITH {BATCHES_SQL}, {binned_sql(NUMERIC)}, {ks_sql(NUMERIC)} SELECT feature, {r('ks', 'ks_statistic')} FROM ks")
def ks_statistic(spark, folder):
    found = drift.ks_statistics(*batches(spark, folder), NUMERIC)
    return rounded(local_rows(spark, list(found.items()), "feature string, ks_statistic double"))


_LAMBDA = "(sqrt(n * m / (n + m)) + 0.12::DOUBLE + 0.11::DOUBLE / sqrt(n * m / (n + m))) * ks"
_PVALUE = f"""CASE WHEN {_LAMBDA} < 0.2::DOUBLE THEN 1::DOUBLE ELSE (SELECT CASE WHEN s < 2.2250738585072014e-308 THEN 0 ELSE least(s, 1::DOUBLE) END
FROM (SELECT list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 2::DOUBLE ELSE -2::DOUBLE END)
* exp(-2::DOUBLE * k * k * ({_LAMBDA}) * ({_LAMBDA})))) AS s)) END"""


def _missing(columns: list[str]) -> str:
    return " UNION ALL ".join(f"""SELECT '{c}' AS feature, {i} AS position, (SELECT avg(({c} IS NULL)::INT) FROM ref) AS rm,
    (SELECT avg(({c} IS NULL)::INT) FROM cur) AS cm""" for i, c in enumerate(columns))


def measures_sql() -> str:
    """One row per feature with every measure, named as in the report."""
    null = {"d": "NULL::DOUBLE", "l": "NULL::BIGINT"}
    return f"""WITH {BATCHES_SQL}, {COUNTS_SQL}, {binned_sql(NUMERIC)}, {ks_sql(NUMERIC)}, ms AS ({_missing(NUMERIC + CATEGORICAL)}),
    mo AS (SELECT feature, avg(x) FILTER (side = 0) AS ra, avg(x) FILTER (side = 1) AS ca, stddev_pop(x) FILTER (side = 0) AS rs,
    stddev_pop(x) FILTER (side = 1) AS cs, count(*) FILTER (side = 0) AS n, count(*) FILTER (side = 1) AS m FROM long GROUP BY 1),
    cd AS ({distance_sql('k', shares=True)}), cn AS (SELECT feature, sum(CASE WHEN ref = 0 THEN cur ELSE 0 END) / sum(cur) AS unseen,
    sum(ref)::BIGINT AS n, sum(cur)::BIGINT AS m, count(*) FILTER (ref > 0) AS rc, count(*) FILTER (cur > 0) AS cc FROM k GROUP BY 1),
    meas AS (SELECT ms.feature, position, 'numeric' AS feature_type, psi, ks AS ks_statistic, {_PVALUE} AS ks_pvalue,
    js AS distribution_distance, {null['d']} AS total_variation_distance, {null['d']} AS unseen_category_rate,
    rm AS reference_missing_rate, cm AS current_missing_rate, cm - rm AS missing_rate_change, ra AS reference_mean, ca AS current_mean,
    rs AS reference_std, cs AS current_std, n AS reference_n, m AS current_n, {null['l']} AS reference_categories,
    {null['l']} AS current_categories FROM ms JOIN mo USING (feature) JOIN nd USING (feature) JOIN ks USING (feature)
    UNION ALL SELECT ms.feature, position, 'categorical', psi, NULL, NULL, js, tv, unseen, rm, cm, cm - rm, NULL, NULL, NULL, NULL,
    n, m, rc, cc FROM ms JOIN cd USING (feature) JOIN cn USING (feature)),
    rep AS (SELECT *, CASE WHEN psi >= 0.25 THEN 'critical' WHEN psi >= 0.1 OR coalesce(ks_pvalue < 0.05 AND ks_statistic >= 0.05, false)
    OR coalesce(unseen_category_rate >= 0.005, false) OR abs(missing_rate_change) >= 0.05 THEN 'warning' ELSE 'stable' END AS drift_status,
    concat_ws('; ', CASE WHEN psi >= 0.25 THEN printf('PSI %.3f >= critical 0.25', psi) WHEN psi >= 0.1 THEN printf('PSI %.3f >= warning 0.1', psi) END,
    CASE WHEN ks_pvalue < 0.05 AND ks_statistic >= 0.05 THEN printf('KS statistic %.3f (p=%.2e)', ks_statistic, ks_pvalue) END,
    CASE WHEN unseen_category_rate >= 0.005 THEN printf('%.1f%% of rows carry categories absent from reference', unseen_category_rate * 100) END,
    CASE WHEN abs(missing_rate_change) >= 0.05 THEN printf('missing rate moved %+.1f%%', missing_rate_change * 100) END) AS said FROM meas),
    report AS (SELECT * EXCLUDE (said), CASE WHEN said = '' THEN 'within thresholds' ELSE said END AS drift_reason FROM rep)"""


_NUMBERS = [c for c, t in drift.MEASURES.items() if t == "double"]
_OTHERS = [c for c, t in drift.MEASURES.items() if t != "double"]


def _columns(extra: str = "") -> str:
    return ", ".join([*_OTHERS, *[r(c, c) for c in _NUMBERS]]) + extra


@query("drift_numeric", f"{measures_sql()} SELECT {_columns()} FROM meas WHERE feature_type = 'numeric'")
def drift_numeric(spark, folder):
    return rounded(drift.numeric_drift(*batches(spark, folder), NUMERIC))


@query("drift_categorical", f"{measures_sql()} SELECT {_columns()} FROM meas WHERE feature_type = 'categorical'")
def drift_categorical(spark, folder):
    return rounded(drift.categorical_drift(*batches(spark, folder), CATEGORICAL))


@query("missing_change", f"""WITH {BATCHES_SQL}, ms AS ({_missing(NUMERIC + CATEGORICAL)}) SELECT feature,
{r('rm', 'reference_missing_rate')}, {r('cm', 'current_missing_rate')}, {r('cm - rm', 'missing_rate_change')} FROM ms""")
def missing_change(spark, folder):
    return rounded(drift.missing_change(*batches(spark, folder), NUMERIC + CATEGORICAL))


@query("drift_classified", f"{measures_sql()} SELECT feature, drift_status, drift_reason FROM report WHERE feature_type = 'categorical'")
def drift_classified(spark, folder):
    made = drift.classified(drift.categorical_drift(*batches(spark, folder), CATEGORICAL))
    return made.select("feature", "drift_status", "drift_reason")


_ABSENT = " UNION ALL SELECT 'gone' AS feature, 'numeric' AS feature_type, NULL, NULL, NULL, NULL, " + ", ".join(
    ["NULL"] * len(_NUMBERS)) + ", 'insufficient_data', 'absent from reference or current batch', 6"


def _report(spark, folder):
    return drift.drift_report(*batches(spark, folder), [*NUMERIC, "gone"], CATEGORICAL)


@query("drift_report", f"""{measures_sql()} SELECT {_columns(", drift_status, drift_reason, (CASE WHEN feature_type = 'numeric' THEN position ELSE position + 1 END)::BIGINT AS position")} FROM report
{_ABSENT}""")
def drift_report(spark, folder):
    return rounded(_report(spark, folder))


_SEVERITY = "CASE drift_status WHEN 'critical' THEN 3 WHEN 'warning' THEN 2 WHEN 'stable' THEN 0 ELSE 1 END"


@query("drift_ordered", f"""{measures_sql()} SELECT feature, drift_status, {r('psi', 'psi')}, row_number() OVER (
ORDER BY {_SEVERITY} DESC, psi DESC NULLS LAST, position) AS place FROM report""")
def drift_ordered(spark, folder):
    from pyspark.sql import Window

    report = drift.drift_report(*batches(spark, folder), NUMERIC, CATEGORICAL)
    order = Window.orderBy(drift.severity(F.col("drift_status")).desc(), F.col("psi").desc_nulls_last(), "position")
    return rounded(drift.ordered(report).select("feature", "drift_status", "psi", F.row_number().over(order).alias("place")))


@query("topk_drift", f"""{measures_sql()} SELECT feature, feature_type, {r('psi', 'psi')}, drift_status, drift_reason FROM report
ORDER BY {_SEVERITY} DESC, report.psi DESC NULLS LAST, position LIMIT 5""")
def topk_drift(spark, folder):
    return rounded(drift.top_drifted(drift.drift_report(*batches(spark, folder), NUMERIC, CATEGORICAL), 5))


@query("missing_movers", f"""WITH {BATCHES_SQL}, ms AS ({_missing(NUMERIC + CATEGORICAL)}) SELECT feature,
{r('cm - rm', 'missing_rate_change')} FROM ms WHERE cm <> rm ORDER BY abs(cm - rm) DESC, feature LIMIT 20""")
def missing_movers(spark, folder):
    return rounded(drift.missing_movers(drift.missing_change(*batches(spark, folder), NUMERIC + CATEGORICAL)))


@query("drift_summary", f"""{measures_sql()}, total AS (SELECT count(*) + 1 AS monitored_features, count(*) FILTER (drift_status = 'stable') AS stable_features,
count(*) FILTER (drift_status = 'warning') AS warning_features, count(*) FILTER (drift_status = 'critical') AS critical_features,
1::BIGINT AS insufficient_features, 0::BIGINT AS error_features FROM report) SELECT *,
{r('(critical_features + warning_features) / monitored_features', 'drifted_feature_ratio')}, 0.2::DOUBLE AS max_drifted_feature_ratio,
CASE WHEN critical_features > 0 OR (critical_features + warning_features) / monitored_features > 0.2 THEN 'critical'
WHEN warning_features > 0 THEN 'warning' ELSE 'stable' END AS status FROM total""")
def drift_summary(spark, folder):
    return rounded(drift.summarise(_report(spark, folder)))


@query("batch_intake", """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END::BIGINT AS TARGET,
true AS labelled FROM orders ORDER BY md5(o_orderkey::VARCHAR || '|42'), o_orderkey LIMIT 2000""")
def batch_intake(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", F.expr(
        "CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS BIGINT)").alias("TARGET"))
    batch, labelled = drift.batch_intake(df, "o_orderkey", "TARGET", 2000)
    return batch.withColumn("labelled", F.lit(labelled))


# prediction drift: early rows against late rows whose score is squared
_SIDES = f"""ref AS (SELECT p FROM ({SCORED_SQL}) WHERE late = 0), cur AS (SELECT round(p * p, 4) AS p FROM ({SCORED_SQL}) WHERE late = 1)"""


def _describe(t: str, name: str) -> str:
    return f"""count(p) AS {name}_n, avg(p) AS {name}_mean_probability, stddev_pop(p) AS {name}_std_probability, min(p) AS {name}_min_probability,
    max(p) AS {name}_max_probability, avg((p >= 0.2)::INT) AS {name}_positive_rate, quantile_cont(p, 0.5) AS {name}_median_probability FROM {t}"""


_PREDICTION = f"""WITH {_SIDES}, {binned_sql(['p'])}, x AS (SELECT {_describe('ref', 'reference')}), y AS (SELECT {_describe('cur', 'current')}),
fe AS (SELECT {EDGES} AS fe), fb AS (SELECT least(len(list_filter(fe, lambda v: v <= x)) - 1, 9) AS bin, side FROM long, fe),
fh AS (SELECT 'score' AS feature, g.bin, count(side) FILTER (side = 0) AS ref, count(side) FILTER (side = 1) AS cur
FROM (SELECT unnest(range(0, 10)) AS bin) g LEFT JOIN fb ON fb.bin = g.bin GROUP BY 1, 2), fd AS ({distance_sql('fh')}),
z AS (SELECT x.*, y.*, nd.psi AS probability_psi, fd.js AS probability_distribution_distance,
current_mean_probability - reference_mean_probability AS mean_probability_change,
current_median_probability - reference_median_probability AS median_probability_change,
current_std_probability - reference_std_probability AS std_probability_change,
current_positive_rate - reference_positive_rate AS positive_rate_change, 0.2::DOUBLE AS threshold FROM x, y, nd, fd),
s AS (SELECT *, CASE WHEN probability_psi >= 0.25 THEN 'critical' WHEN probability_psi >= 0.1 OR abs(mean_probability_change) >= 0.05
OR abs(positive_rate_change) >= 0.05 THEN 'warning' ELSE 'stable' END AS status, concat_ws('; ',
CASE WHEN probability_psi >= 0.25 THEN printf('probability PSI %.3f >= critical 0.25', probability_psi)
WHEN probability_psi >= 0.1 THEN printf('probability PSI %.3f >= warning 0.1', probability_psi) END,
CASE WHEN abs(mean_probability_change) >= 0.05 THEN printf('mean probability moved %+.4f (limit 0.05)', mean_probability_change) END,
CASE WHEN abs(positive_rate_change) >= 0.05 THEN printf('positive rate moved %+.4f (limit 0.05)', positive_rate_change) END) AS reasons FROM z)"""


def _prediction(spark, folder):
    return scores.prediction_drift(*_score_sides(spark, folder), "p", 0.2)


_PRED_NUMBERS = [f"{s}_{k}" for s in ("reference", "current") for k in (
    "mean_probability", "std_probability", "min_probability", "max_probability", "positive_rate", "median_probability")] + [
    "probability_psi", "probability_distribution_distance", "mean_probability_change", "median_probability_change",
    "std_probability_change", "positive_rate_change"]


@query("prediction_drift", f"{_PREDICTION} SELECT reference_n, current_n, threshold, status, reasons, "
       + ", ".join(r(c, c) for c in _PRED_NUMBERS) + " FROM s")
def prediction_drift(spark, folder):
    return rounded(_prediction(spark, folder))


@query("prediction_drift_stored", f"{_PREDICTION} SELECT reference_n, current_n, threshold, status, reasons, "
       + ", ".join(r(c, c) for c in _PRED_NUMBERS) + " FROM s")
def prediction_drift_stored(spark, folder):
    """The reference is profiled and stored; the comparison reads the profile and the current batch alone."""
    reference, current = _score_sides(spark, folder)
    path = scores.ScoreProfile.of(reference, "p", 0.2).save(spark, shared_folder(spark, "score-profile"))
    return rounded(scores.prediction_drift_from(scores.ScoreProfile.load(spark, path), current, "p"))


@query("prediction_status", f"{_PREDICTION} SELECT status, reasons FROM s")
def prediction_status(spark, folder):
    return _prediction(spark, folder).select("status", "reasons")
