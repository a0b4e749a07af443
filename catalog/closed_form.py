"""Learned models whose answers SQL can derive: a saturated logistic model and a tree of one split.

With one category as the only input and no penalty, a logistic model's probability of a category is the (class-weighted)
share of positives in it. A tree of depth one on a two-valued input has one share per side, and a row's attribution is
its side's share less the mean over all rows.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from catalog.models import KEY, LABEL, written_table
from catalog.registry import query, r, rounded
from riskloom.operators import attribution, scoring, training
from riskloom.operators.tree_attribution import tree_attribution

_ROWS = """t AS (SELECT o_orderkey AS k, {g} AS g, CASE WHEN o_totalprice + (o_orderkey % 101) * 1000 > 450000 THEN 1 ELSE 0 END AS y
FROM orders), n AS (SELECT sum(y)::DOUBLE AS n1, (count(*) - sum(y))::DOUBLE AS n0 FROM t),
s AS (SELECT g, count(*) AS n, sum(y) / any_value(n1) AS a, (count(*) - sum(y)) / any_value(n0) AS b FROM t, n GROUP BY g),
p AS (SELECT g, n, a / (a + b) AS p FROM s)"""
_BY_PRIORITY = _ROWS.format(g="o_orderpriority")
_BY_URGENCY = _ROWS.format(g="(o_orderpriority = '1-URGENT')")


def saturated_scorer(spark, folder):
    df = written_table(spark, folder)
    frame = training.training_frame(df, LABEL)
    model = training.baseline_model(float(frame.rows), c=1e9, max_iter=1000).setTol(1e-12)
    fitted = training.model_pipeline(model, ["o_orderpriority"]).fit(frame.data)
    return df, scoring.Scorer(fitted, {"model_name": "saturated", "optimal_threshold": 0.5, "promoted": True,
                                       "input_feature_columns": ["o_orderpriority"]})


@query("score_saturated", f"""WITH {_BY_PRIORITY} SELECT k AS {KEY}, {r('p', 'p', 3)}, (p >= 0.5)::BIGINT AS cls
FROM t JOIN p USING (g)""")
def score_saturated(spark, folder):
    df, scorer = saturated_scorer(spark, folder)
    made = scorer.predict(df)
    return rounded(made.select(KEY, F.col("DEFAULT_PROBABILITY").alias("p"), F.col("PREDICTED_CLASS").alias("cls")), 3)


@query("score_requests", f"""WITH {_BY_PRIORITY} SELECT row_number() OVER (ORDER BY k DESC) AS request_pos, k AS {KEY}, {r('p', 'p', 3)}
FROM t JOIN p USING (g)""")
def score_requests(spark, folder):
    df, scorer = saturated_scorer(spark, folder)
    top = df.agg(F.max(KEY)).first()[0]
    asked = df.select(KEY, (F.lit(top) - F.col(KEY) + 1).alias("request_pos"))
    made = scoring.score_requests(scorer, asked, df)
    return rounded(made.select("request_pos", KEY, F.col("DEFAULT_PROBABILITY").alias("p")), 3)


@query("attribution_stump", f"""WITH {_BY_URGENCY}, m AS (SELECT sum(n * p) / sum(n) AS mean FROM p)
SELECT k AS {KEY}, {r('p', 'score')}, {r('p - mean', 'attribution')}, {r('mean', 'base')} FROM t JOIN p USING (g), m""")
def attribution_stump(spark, folder):
    df = written_table(spark, folder).select(KEY, LABEL, (F.col("o_orderpriority") == "1-URGENT").cast("string").alias("urgent"))
    frame = training.training_frame(df, LABEL)
    stump = RandomForestClassifier(featuresCol="features", labelCol=training.LABEL, weightCol=training.WEIGHT, numTrees=1, maxDepth=1,
                                   featureSubsetStrategy="all", bootstrap=False, seed=1)
    fitted = training.model_pipeline(stump, ["urgent"]).fit(frame.data)
    rows, base = tree_attribution(training.with_score(fitted.transform(df)), fitted.stages[-1])
    total = attribution.array_total(F.col("attribution"))
    return rounded(rows.select(KEY, F.col(training.SCORE).alias("score"), total.alias("attribution"), F.lit(base).alias("base")))
