"""Set operations, sorting, top-k and picks."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.aggregates import METRICS_SQL
from catalog.inputs import BATCH_COLUMNS, CATEGORICAL, NUMERIC, RATED_SQL, SCORED_SQL, batches, rated, scored
from catalog.registry import query, r, rnd, rounded, table
from riskloom.operators import attribution, drift, fairness, performance, scoring, selection


def group_sql(source: str, columns: tuple[str, ...], threshold: float, minimum: int) -> str:
    """Group metrics as a query of SQL text, one block per grouping column."""
    def block(c: str) -> str:
        return f"""SELECT '{c}' AS group_column, {c} AS group_value, count(*) AS n, avg((p >= {threshold})::INT) AS ppr,
        avg(p) AS mp, avg(y) AS adr, (count(*) FILTER (y = 1 AND p >= {threshold}))::DOUBLE AS tp,
        (count(*) FILTER (y = 0 AND p >= {threshold}))::DOUBLE AS fp, (count(*) FILTER (y = 1 AND p < {threshold}))::DOUBLE AS fn,
        (count(*) FILTER (y = 0 AND p < {threshold}))::DOUBLE AS tn FROM ({source}) WHERE {c} IS NOT NULL GROUP BY 2"""
    ok = f"n >= {minimum}"
    return f"""SELECT group_column, group_value, n, CASE WHEN {ok} THEN {r('ppr')} END AS positive_prediction_rate,
    CASE WHEN {ok} THEN {r('mp')} END AS mean_probability, CASE WHEN {ok} THEN {r('adr')} END AS actual_default_rate,
    CASE WHEN {ok} THEN CASE WHEN tp + fp > 0 THEN {r('tp / (tp + fp)')} ELSE 0 END END AS precision,
    CASE WHEN {ok} AND tp + fn > 0 THEN {r('tp / (tp + fn)')} END AS recall,
    CASE WHEN {ok} THEN CASE WHEN fp + tn > 0 THEN {r('fp / (fp + tn)')} ELSE 0 END END AS false_positive_rate,
    CASE WHEN {ok} AND tp + fn > 0 THEN {r('fn / (fn + tp)')} END AS false_negative_rate,
    CASE WHEN {ok} THEN 'measured' ELSE 'insufficient_data' END AS status,
    CASE WHEN {ok} THEN '' ELSE n || ' rows, minimum {minimum}' END AS note FROM ({' UNION ALL '.join(map(block, columns))})"""


@query("union_groups", group_sql(SCORED_SQL, ("l_linestatus", "l_returnflag"), 0.2, 100))
def union_groups(spark, folder):
    return rounded(fairness.group_metrics(scored(spark, folder), ["l_linestatus", "l_returnflag"], "p", 0.2, "y"))


@query("union_requests", """SELECT c_custkey AS id, 'app' AS channel, c_acctbal AS amount FROM customer
UNION ALL SELECT s_suppkey, 'partner', NULL FROM supplier UNION ALL SELECT o_custkey, NULL, o_totalprice FROM orders""")
def union_requests(spark, folder):
    app = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.lit("app").alias("channel"), F.col("c_acctbal").alias("amount"))
    partner = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("partner").alias("channel"))
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("amount"))
    return app.unionByName(partner, allowMissingColumns=True).unionByName(orders, allowMissingColumns=True)


@query("duplicate_ids", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(spark, folder):
    return scoring.duplicate_ids(table(spark, folder, "orders"), "o_custkey")


def _equal(a: str, b: str) -> str:
    return f"NOT EXISTS ({a} EXCEPT ALL {b}) AND NOT EXISTS ({b} EXCEPT ALL {a}) AS identical"


_SHIFTED = "SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders"
_TWICE = "SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 100 = 0"


@query("batches_identical", f"""SELECT 'same' AS pair, {_equal('FROM orders', 'FROM orders')}
UNION ALL SELECT 'reordered', {_equal('FROM orders', '(FROM orders ORDER BY o_totalprice)')}
UNION ALL SELECT 'shifted', {_equal('FROM orders', _SHIFTED)}
UNION ALL SELECT 'repeated', {_equal('FROM orders', '(' + _TWICE + ')')}
UNION ALL SELECT 'shorter', count(*) = (SELECT count(*) FROM customer) FROM orders""")
def batches_identical(spark, folder):
    from riskloom.functions.columns import local_rows

    orders = table(spark, folder, "orders")
    rows = [("same", drift.batches_identical(orders, orders)),
            ("reordered", drift.batches_identical(orders, orders.select(*reversed(orders.columns)).repartition(4))),
            ("shifted", drift.batches_identical(orders, orders.withColumn("o_totalprice", F.col("o_totalprice") + 1))),
            ("repeated", drift.batches_identical(orders, orders.unionByName(orders.filter("o_orderkey % 100 = 0")))),
            ("shorter", drift.batches_identical(orders, table(spark, folder, "customer")))]
    return local_rows(spark, rows, "pair string, identical boolean")


# candidates: one "model" per return flag and line status, measured on its own rows
CANDIDATES_SQL = f"""s AS (SELECT l_returnflag || l_linestatus AS model, p, sum(late) AS tp, count(*) - sum(late) AS fp
FROM ({SCORED_SQL}) GROUP BY 1, 2), w AS (SELECT *, sum(tp) OVER (PARTITION BY model ORDER BY p DESC) AS ctp,
sum(fp) OVER (PARTITION BY model ORDER BY p DESC) AS cfp FROM s),
rk AS (SELECT model, sum(fp * (ctp - tp / 2))::DOUBLE / (sum(tp) * sum(fp)) AS auc, sum(tp * ctp / (ctp + cfp)) / sum(tp) AS ap
FROM w GROUP BY 1)"""


def candidates(spark, folder):
    df = scored(spark, folder).withColumn("Model", F.concat("l_returnflag", "l_linestatus"))
    return performance.evaluate(df, "late", "p", 0.5, ["Model"])


def candidate_metrics(spark, folder):
    return candidates(spark, folder).select("Model", F.col("average_precision").alias("Average Precision"),
                                            F.col("roc_auc").alias("ROC-AUC"), F.col("recall").alias("Recall"))


@query("leaderboard", f"""WITH {CANDIDATES_SQL} SELECT model AS Model, {r('ap', 'average_precision')}, {r('auc', 'roc_auc')},
row_number() OVER (ORDER BY ap DESC, model) AS rank FROM rk""")
def leaderboard(spark, folder):
    board = selection.leaderboard(candidate_metrics(spark, folder))
    return rounded(board.select("Model", F.col("Average Precision").alias("average_precision"),
                                F.col("ROC-AUC").alias("roc_auc"), "rank"))


@query("importance_rank", """WITH m AS (SELECT i, avg(abs(embedding[i]::DOUBLE)) AS v FROM embeddings,
(SELECT unnest(range(1, 65)) AS i) GROUP BY i) SELECT 'dim' || (i - 1) AS feature, round(v, 6) + 0.0::DOUBLE AS mean_abs,
row_number() OVER (ORDER BY v DESC, i) AS rank FROM m""")
def importance_rank(spark, folder):
    df = table(spark, folder, "embeddings").withColumn("a", F.col("embedding").cast("array<double>"))
    return rounded(attribution.importance(df, "a", [f"dim{i}" for i in range(64)]))


@query("top_contributors", """WITH c AS (SELECT vec_id, i, embedding[i]::DOUBLE AS a FROM embeddings, (SELECT unnest(range(1, 65)) AS i)),
t AS (SELECT vec_id, i, a, CASE WHEN a > 0 THEN 'up' ELSE 'down' END AS direction, row_number() OVER (
PARTITION BY vec_id, a > 0 ORDER BY abs(a) DESC, i) AS place FROM c WHERE a <> 0)
SELECT vec_id, direction, place, 'dim' || (i - 1) AS feature, round(a * 2, 6) + 0.0::DOUBLE AS feature_value,
round(a, 6) + 0.0::DOUBLE AS attribution FROM t WHERE place <= 10""")
def top_contributors(spark, folder):
    df = table(spark, folder, "embeddings").withColumn("a", F.col("embedding").cast("array<double>")).withColumn(
        "v", F.transform("a", lambda x: x * 2))
    explained = attribution.explain_rows(df, "a", "v", [f"dim{i}" for i in range(64)])
    return rounded(attribution.contributor_rows(explained, ["vec_id"]))


@query("local_examples", f"""WITH t AS ({RATED_SQL}), c AS (
SELECT 0 AS position, 'highest_risk' AS reason, (SELECT o_orderkey FROM t ORDER BY p DESC, o_orderkey LIMIT 1) AS o_orderkey
UNION ALL SELECT 1, 'lowest_risk', (SELECT o_orderkey FROM t ORDER BY p, o_orderkey LIMIT 1)
UNION ALL SELECT 2, 'nearest_threshold', (SELECT o_orderkey FROM t ORDER BY abs(p - 0.5::DOUBLE), o_orderkey LIMIT 1)
UNION ALL SELECT 3, 'true_positive', (SELECT o_orderkey FROM t WHERE y = 1 AND p >= 0.5 ORDER BY p DESC, o_orderkey LIMIT 1)
UNION ALL SELECT 4, 'false_negative', (SELECT o_orderkey FROM t WHERE y = 1 AND p < 0.5 ORDER BY p DESC, o_orderkey LIMIT 1)),
u AS (SELECT o_orderkey, min(position) AS place, arg_min(reason, position) AS reason FROM c WHERE o_orderkey IS NOT NULL GROUP BY 1),
k AS (SELECT count(*) AS k FROM u), more AS (SELECT o_orderkey, row_number() OVER (ORDER BY p DESC, o_orderkey) AS i FROM t
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM u) QUALIFY i <= 6)
SELECT row_number() OVER (ORDER BY place) - 1 AS position, reason, o_orderkey FROM u
UNION ALL SELECT k + i - 1, 'high_risk_' || (k + i - 1), o_orderkey FROM more, k WHERE k + i <= 6""")
def local_examples(spark, folder):
    return rounded(attribution.local_examples(rated(spark, folder), "o_orderkey", "p", 0.5, 6, "y"))


@query("group_feed", f"""WITH g AS ({group_sql(SCORED_SQL, ('l_linestatus', 'l_returnflag'), 0.2, 100)})
SELECT group_column, group_value, n, 'recall' AS metric, recall AS value FROM g WHERE status = 'measured' AND recall IS NOT NULL
QUALIFY count(*) OVER (PARTITION BY group_column) >= 2""")
def group_feed(spark, folder):
    groups = fairness.group_metrics(scored(spark, folder), ["l_linestatus", "l_returnflag"], "p", 0.2, "y")
    return rounded(fairness.comparable_groups(groups, True))


@query("pr_curve", f"""WITH {METRICS_SQL} SELECT p AS threshold, {r('ctp / (ctp + cfp)', 'precision')},
{r('ctp / (SELECT sum(tp) FROM s)', 'recall')} FROM w""")
def pr_curve(spark, folder):
    return rounded(performance.precision_recall_curve(performance.score_curve(scored(spark, folder), "y", "p")))
