"""Rollups, profiles, histograms and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import (
    APPLICANT_SQL, BATCHES_SQL, RATED_SQL, SCORED_SQL, applicant, batches, credit_tables, rated, scored)
from catalog.registry import query, r, rnd, rounded, table
from riskloom.operators import attribution, contracts, drift, features, performance, quality, rollup, sampling, scores, scoring


def _stats(prefix: str, column: str, source: str, first: bool = False, whole: bool = False, digits: int = 4) -> str:
    name, x = f"{prefix}_{column}", source
    cast = "::BIGINT" if whole else ""
    out = [f"round(min({x}), {digits}) + 0.0::DOUBLE AS {name}_min" if not whole else f"min({x})::BIGINT AS {name}_min",
           f"round(max({x}), {digits}) + 0.0::DOUBLE AS {name}_max" if not whole else f"max({x})::BIGINT AS {name}_max",
           f"round(avg({x}), {digits}) + 0.0::DOUBLE AS {name}_mean",
           f"round(coalesce(sum({x}), 0), {digits}) + 0.0::DOUBLE AS {name}_sum" if not whole
           else f"coalesce(sum({x}), 0){cast} AS {name}_sum"]
    return ", ".join(out + ([f"count({x}) AS {name}_count"] if first else []))


# Money is cut to whole units here: sums of whole numbers are exact in both engines, so means agree to the last digit.
_WHOLE_PRICE = "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(floor(o_totalprice) AS DOUBLE) END"


@query("rollup_child", "SELECT o_custkey, " + _stats("ord", "o_orderkey", "o_orderkey", True, True) + ", "
       + _stats("ord", "o_totalprice", _WHOLE_PRICE) + " FROM orders GROUP BY o_custkey")
def rollup_child(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", F.expr(_WHOLE_PRICE).alias("o_totalprice"), "o_orderstatus")
    return rounded(rollup.rollup(orders, "o_custkey", "ord"), 4)


@query("rollup_keys_only", "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey % 10 <> 0 OR o_custkey IS NULL")
def rollup_keys_only(spark, folder):
    keyed = table(spark, folder, "orders").select(
        F.expr("CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_custkey END").alias("o_custkey"), "o_orderstatus")
    return rollup.rollup(keyed, "o_custkey", "none")


_TWO_LEVEL = f"""WITH g AS (SELECT l_orderkey, {_stats('bb', 'QTY', 'l_quantity', True, digits=12)},
{_stats('bb', 'PRICE', 'floor(l_extendedprice / 100)', digits=12)} FROM lineitem GROUP BY 1),
b AS (SELECT o_custkey, o_orderkey, floor(o_totalprice) AS amt, g.* EXCLUDE (l_orderkey) FROM orders LEFT JOIN g ON o_orderkey = l_orderkey)
SELECT o_custkey AS SK_ID_CURR, {_stats('bureau', 'SK_ID_BUREAU', 'o_orderkey', True, True, 7)},
{_stats('bureau', 'AMT', 'amt', digits=7)}, {', '.join(_stats('bureau', f'bb_{c}_{s}', f'bb_{c}_{s}', digits=7)
for c in ('QTY', 'PRICE') for s in ('min', 'max', 'mean', 'sum'))},
{_stats('bureau', 'bb_QTY_count', 'bb_QTY_count', whole=True, digits=7)} FROM b GROUP BY 1"""


def _two_level(spark, folder):
    t = credit_tables(spark, folder)
    return rollup.two_level_rollup(t["bureau"], t["bureau_balance"], "SK_ID_BUREAU", "SK_ID_CURR", "bb", "bureau")


@query("rollup_two_level", _TWO_LEVEL)
def rollup_two_level(spark, folder):
    return rounded(_two_level(spark, folder), 7)


@query("table_profile", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, {n}::BIGINT AS n_columns FROM {t}"
    for t, n in (("customer", 5), ("orders", 6), ("lineitem", 11), ("events", 6))))
def table_profile(spark, folder):
    return contracts.table_profile({t: table(spark, folder, t) for t in ("customer", "orders", "lineitem", "events")})


_PROFILED = "SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_returnflag END AS flag, " \
            "CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE l_tax END AS tax FROM lineitem"


@query("quality_profile", f"""WITH t AS ({_PROFILED}), n AS (SELECT count(*)::DOUBLE AS rows FROM t)
SELECT 'shape' AS section, 'rows' AS item, rows AS value FROM n
UNION ALL SELECT 'shape', 'columns', 4.0::DOUBLE
UNION ALL SELECT * FROM (VALUES ('dtype', 'bigint', 1.0::DOUBLE), ('dtype', 'int', 1.0::DOUBLE), ('dtype', 'string', 1.0::DOUBLE), ('dtype', 'double', 1.0::DOUBLE))
UNION ALL SELECT 'missing_count', 'flag', count(*)::DOUBLE FROM t WHERE flag IS NULL
UNION ALL SELECT 'missing_count', 'tax', count(*)::DOUBLE FROM t WHERE tax IS NULL
UNION ALL SELECT 'missing_pct', 'flag', {r('100.0::DOUBLE * count(*) / any_value(rows)')} FROM t, n WHERE flag IS NULL
UNION ALL SELECT 'missing_pct', 'tax', {r('100.0::DOUBLE * count(*) / any_value(rows)')} FROM t, n WHERE tax IS NULL
UNION ALL SELECT 'duplicates', 'rows', rows - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) FROM n""")
def quality_profile(spark, folder):
    return rounded(quality.quality_profile(table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_returnflag END AS flag",
        "CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE l_tax END AS tax")))


@query("class_balance", f"""WITH b AS (SELECT count(*) FILTER (TARGET = 1) AS positives, count(*) FILTER (TARGET = 0) AS negatives
FROM ({APPLICANT_SQL})) SELECT positives, negatives, {r('negatives / positives', 'scale_pos_weight')},
{r('(positives + negatives) / (2 * positives)', 'weight_positive')},
{r('(positives + negatives) / (2 * negatives)', 'weight_negative')} FROM b""")
def class_balance(spark, folder):
    return rounded(sampling.class_balance(applicant(spark, folder), "TARGET"))


@query("confusion_counts", f"""SELECT count(*) FILTER (y = 0 AND p < 0.2) AS tn, count(*) FILTER (y = 0 AND p >= 0.2) AS fp,
count(*) FILTER (y = 1 AND p < 0.2) AS fn, count(*) FILTER (y = 1 AND p >= 0.2) AS tp FROM ({SCORED_SQL})""")
def confusion_counts(spark, folder):
    return performance.confusion_counts(scored(spark, folder), "y", "p", 0.2)


@query("score_summary", f"""SELECT count(p) AS n, {r('avg(p)', 'mean_probability')}, {r('stddev_pop(p)', 'std_probability')},
{r('min(p)', 'min_probability')}, {r('max(p)', 'max_probability')}, {r('avg((p >= 0.2)::INT)', 'positive_rate')},
{r('quantile_cont(p, 0.5)', 'median_probability')}, 0.2::DOUBLE AS threshold FROM ({SCORED_SQL})""")
def score_summary(spark, folder):
    return rounded(scores.describe_scores(scored(spark, folder), "p", 0.2))


EDGES = "[" + ", ".join(f"{e!r}::DOUBLE" for e in scores.PROBABILITY_EDGES) + "]"


@query("histogram_fixed", f"""WITH g AS (SELECT unnest(range(0, 10)) AS bin), e AS (SELECT {EDGES} AS e),
c AS (SELECT least(len(list_filter(e, lambda v: v <= p)) - 1, 9) AS bin, count(*) AS n FROM ({SCORED_SQL}), e GROUP BY 1)
SELECT g.bin::BIGINT AS bin, {r('e[g.bin + 1]', 'low')}, {r('e[g.bin + 2]', 'high')}, coalesce(n, 0) AS n
FROM g CROSS JOIN e LEFT JOIN c ON c.bin = g.bin""")
def histogram_fixed(spark, folder):
    return rounded(scores.score_histogram(scored(spark, folder), "p"))


_LEVELS = "[0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]"


@query("quantile_edges", " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, (row_number() OVER (ORDER BY edge))::BIGINT AS place, {r('edge', 'edge')}
    FROM (SELECT DISTINCT unnest(quantile_cont({c}, {_LEVELS})) AS edge FROM lineitem)"""
    for c in ("l_quantity", "l_extendedprice", "l_discount")))
def quantile_edges(spark, folder):
    from riskloom.functions.columns import local_rows

    edges = drift.quantile_edges(table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    rows = [(c, i + 1, v) for c, vs in edges.items() for i, v in enumerate(vs)]
    return rounded(local_rows(spark, rows, "feature string, place long, edge double"))


@query("category_freq", " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, {c} AS value, count(*) AS n, {r('count(*) / (SELECT count(*) FROM orders)', 'share')}
    FROM orders GROUP BY 2""" for c in ("o_orderstatus", "o_orderpriority")))
def category_freq(spark, folder):
    return rounded(drift.category_shares(table(spark, folder, "orders"), ["o_orderstatus", "o_orderpriority"]))


@query("mean_abs", """SELECT (i - 1)::BIGINT AS position, 'dim' || (i - 1) AS feature,
round(avg(abs(embedding[i]::DOUBLE)), 6) + 0.0::DOUBLE AS mean_abs
FROM embeddings, (SELECT unnest(range(1, 65)) AS i) GROUP BY i""")
def mean_abs(spark, folder):
    df = table(spark, folder, "embeddings").withColumn("a", F.col("embedding").cast("array<double>"))
    return rounded(attribution.mean_absolute(df, "a", [f"dim{i}" for i in range(64)]))


_EVENTS = "SELECT user_id, " + _stats("ev", "value", "floor(value)", True) + " FROM events GROUP BY 1"


@query("left_join_rollup", f"""WITH ev AS ({_EVENTS}) SELECT c_custkey, {r('c_acctbal', 'c_acctbal', 4)}, ev.* EXCLUDE (user_id)
FROM customer LEFT JOIN ev ON c_custkey = user_id""")
def left_join_rollup(spark, folder):
    rolled = rollup.rollup(table(spark, folder, "events").select(
        "user_id", F.floor("value").cast("double").alias("value")), "user_id", "ev")
    base = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return rounded(rollup.attach(base, rolled.withColumnRenamed("user_id", "c_custkey"), "c_custkey"), 4)


_TABLE_CHILDREN = (rollup.ChildTable("bureau", "bureau", "bureau_balance", "SK_ID_BUREAU", "bb"),
                   rollup.ChildTable("previous_application", "prev"))


@query("feature_table", f"""WITH a AS (SELECT SK_ID_CURR, TARGET::BIGINT AS TARGET, AMT_INCOME_TOTAL, AMT_CREDIT, AMT_ANNUITY FROM ({APPLICANT_SQL})),
u AS ({_TWO_LEVEL}), v AS (SELECT user_id, {_stats('prev', 'VALUE', 'floor(value)', True, digits=7)} FROM events GROUP BY 1)
SELECT a.* REPLACE ({r('AMT_INCOME_TOTAL', 'AMT_INCOME_TOTAL', 7)}, {r('AMT_CREDIT', 'AMT_CREDIT', 7)},
{r('AMT_ANNUITY', 'AMT_ANNUITY', 7)}), u.* EXCLUDE (SK_ID_CURR), v.* EXCLUDE (user_id),
{r('AMT_ANNUITY / (AMT_INCOME_TOTAL + 1e-6)', 'DEBT_BURDEN_RATIO', 7)},
{r('AMT_CREDIT / (AMT_INCOME_TOTAL + 1e-6)', 'CREDIT_INCOME_RATIO', 7)},
{r('AMT_ANNUITY / (AMT_CREDIT + 1e-6)', 'ANNUITY_CREDIT_RATIO', 7)}, {r('AMT_ANNUITY / (AMT_CREDIT + 1e-6)', 'PAYMENT_RATE', 7)}
FROM a LEFT JOIN u ON u.SK_ID_CURR = a.SK_ID_CURR LEFT JOIN v ON v.user_id = a.SK_ID_CURR""")
def feature_table(spark, folder):
    made = rollup.feature_table(credit_tables(spark, folder), children=_TABLE_CHILDREN)
    return rounded(features.add_domain_features(made), 7)


_STORE = "SELECT user_id AS id, count(*) AS events, max(value) AS top FROM events GROUP BY 1"


def _store(spark, folder):
    return table(spark, folder, "events").groupBy(F.col("user_id").alias("id")).agg(
        F.count(F.lit(1)).alias("events"), F.max("value").alias("top"))


@query("lookup_found", f"""SELECT c_custkey AS id, c_name, events, {r('top', 'top')} FROM customer
JOIN ({_STORE}) s ON s.id = c_custkey""")
def lookup_found(spark, folder):
    asked = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    return rounded(scoring.lookup_features(asked, _store(spark, folder), "id")[0])


@query("lookup_missing", f"SELECT c_custkey AS id, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def lookup_missing(spark, folder):
    asked = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    return scoring.lookup_features(asked, _store(spark, folder), "id")[1]


def _clustered(spark, folder):
    from riskloom.session import shared_folder
    from riskloom.sources.feature_store import FeatureStore

    path = shared_folder(spark, "feature-store")
    FeatureStore.write(_store(spark, folder), path, "id", rows_per_bucket=50)
    return FeatureStore.open(spark, path), table(spark, folder, "nation").select(F.col("n_nationkey").cast("long").alias("id"), "n_name")


@query("lookup_store", f"""SELECT n_nationkey::BIGINT AS id, n_name, events, {r('top', 'top')} FROM nation JOIN ({_STORE}) s ON s.id = n_nationkey
UNION ALL SELECT n_nationkey::BIGINT, n_name, NULL, NULL FROM nation WHERE n_nationkey NOT IN (SELECT user_id FROM events)""")
def lookup_store(spark, folder):
    store, asked = _clustered(spark, folder)
    found, unknown = store.lookup(asked)
    return rounded(found.unionByName(unknown, allowMissingColumns=True))


CAT = ("l_returnflag", "l_linestatus", "mode")
COUNTS_SQL = "k AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS part, count(*) FILTER (side = 0) AS ref, count(*) FILTER (side = 1) AS cur "
    f"FROM (SELECT {c}, 0 AS side FROM ref UNION ALL SELECT {c}, 1 FROM cur) WHERE {c} IS NOT NULL GROUP BY 2"
    for c in CAT) + ")"


@query("unseen_rate", f"""WITH {BATCHES_SQL}, {COUNTS_SQL} SELECT feature,
{r('sum(CASE WHEN ref = 0 THEN cur ELSE 0 END) / sum(cur)', 'unseen_category_rate')}, sum(ref)::BIGINT AS reference_n,
sum(cur)::BIGINT AS current_n, count(*) FILTER (ref > 0) AS reference_categories, count(*) FILTER (cur > 0) AS current_categories
FROM k GROUP BY 1""")
def unseen_rate(spark, folder):
    return rounded(drift.unseen_rates(drift.category_counts(*batches(spark, folder), list(CAT))))


@query("freq_align", f"WITH {BATCHES_SQL}, {COUNTS_SQL} SELECT * FROM k")
def freq_align(spark, folder):
    return drift.category_counts(*batches(spark, folder), list(CAT))


BASELINE = {"Average Precision": 0.31, "ROC-AUC": 0.55, "Recall": 0.5, "Other": 1.0}
METRICS_SQL = f"""s AS (SELECT p, sum(y) AS tp, count(*) - sum(y) AS fp FROM ({SCORED_SQL}) GROUP BY p),
w AS (SELECT *, sum(tp) OVER (ORDER BY p DESC) AS ctp, sum(fp) OVER (ORDER BY p DESC) AS cfp FROM s),
rk AS (SELECT sum(fp * (ctp - tp / 2))::DOUBLE / (sum(tp) * sum(fp)) AS auc, sum(tp * ctp / (ctp + cfp)) / sum(tp) AS ap FROM w),
cf AS (SELECT (count(*) FILTER (y = 0 AND p < 0.2))::DOUBLE AS tn, (count(*) FILTER (y = 0 AND p >= 0.2))::DOUBLE AS fp,
(count(*) FILTER (y = 1 AND p < 0.2))::DOUBLE AS fn, (count(*) FILTER (y = 1 AND p >= 0.2))::DOUBLE AS tp FROM ({SCORED_SQL})),
m AS (SELECT 'Average Precision' AS metric, ap AS value FROM rk UNION ALL SELECT 'ROC-AUC', auc FROM rk
UNION ALL SELECT 'Accuracy', (tp + tn) / (tp + tn + fp + fn) FROM cf UNION ALL SELECT 'Precision', tp / (tp + fp) FROM cf
UNION ALL SELECT 'Recall', tp / (tp + fn) FROM cf UNION ALL SELECT 'F1', 2 * tp / (2 * tp + fp + fn) FROM cf)"""


def metrics(spark, folder):
    return performance.metric_rows(performance.evaluate(scored(spark, folder), "y", "p", 0.2))


@query("baseline_compare", f"""WITH {METRICS_SQL}, b(metric, baseline) AS (VALUES ('Average Precision', 0.31::DOUBLE),
('ROC-AUC', 0.55::DOUBLE), ('Recall', 0.5::DOUBLE)) SELECT metric, {r('value', 'current')}, baseline,
{r('value - baseline', 'change')} FROM m JOIN b USING (metric)""")
def baseline_compare(spark, folder):
    return rounded(performance.compare_to_baseline(metrics(spark, folder), BASELINE))


@query("gate_check", f"""WITH {METRICS_SQL}, g(metric, floor) AS (VALUES ('Average Precision', 0.15::DOUBLE), ('ROC-AUC', 0.65::DOUBLE),
('Recall', 0.35::DOUBLE), ('Precision', 0.2::DOUBLE), ('F1', 0.25::DOUBLE))
SELECT metric, {r('value', 'value')}, floor, value >= floor AS passed FROM m JOIN g USING (metric)""")
def gate_check(spark, folder):
    return rounded(performance.gate_check(metrics(spark, folder)))
