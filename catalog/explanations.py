"""Attributions of a linear model as SQL, and of learned models as jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import applicant
from catalog.models import INTERCEPT, KEY, LABEL, MARGIN_SQL, WEIGHTS, _linear, baseline_scorer, written_table
from catalog.registry import query, r, rnd, rounded, table
from riskloom.operators import attribution, training
from riskloom.plans.explain import attributed, explain_job
from riskloom.operators.scoring import Scorer

NAMES, COEF = list(WEIGHTS), list(WEIGHTS.values())


@query("margin_linear", f"SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, {r(MARGIN_SQL, 'margin')} FROM lineitem")
def margin_linear(spark, folder):
    return rounded(_linear(spark, folder).select("l_orderkey", "l_linenumber", "margin"))


def _attributed(spark, folder):
    df = _linear(spark, folder)
    means = attribution.background_means(df, NAMES)
    base = attribution.linear_base(COEF, [means[c] for c in NAMES], INTERCEPT)
    values = [F.col(c) for c in NAMES]
    return df.withColumn("values", F.array(*values)).withColumn(
        "attribution", attribution.linear_attribution(values, COEF, [means[c] for c in NAMES])), base


_BASE = " + ".join(f"(SELECT avg({c}) FROM lineitem) * ({w})::DOUBLE" for c, w in WEIGHTS.items()) + f" + ({INTERCEPT})::DOUBLE"


@query("attribution_linear", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, " + ", ".join(
    r(f"({c} - (SELECT avg({c}) FROM lineitem)) * ({w})::DOUBLE", f"a_{c}") for c, w in WEIGHTS.items())
    + f", {r(_BASE, 'base')} FROM lineitem")
def attribution_linear(spark, folder):
    df, base = _attributed(spark, folder)
    return rounded(df.select("l_orderkey", "l_linenumber", *[F.col("attribution")[i].alias(f"a_{c}") for i, c in enumerate(NAMES)],
                             F.lit(base).alias("base")))


@query("additivity", f"""SELECT {r('''max(abs(b + a - margin))''', 'max_abs_error')}, 0.001::DOUBLE AS tolerance,
max(abs(b + a - margin)) <= 0.001 AS passed FROM (SELECT {MARGIN_SQL} AS margin, {_BASE} AS b, {' + '.join(
f'({c} - (SELECT avg({c}) FROM lineitem)) * ({w})::DOUBLE' for c, w in WEIGHTS.items())} AS a FROM lineitem)""")
def additivity(spark, folder):
    df, base = _attributed(spark, folder)
    return rounded(attribution.additivity(df, "attribution", F.lit(base), "margin"))


@query("attribution_valid", """SELECT count(*) AS n_rows, count(*) FILTER (l_linenumber = 7) AS wrong_width,
count(*) FILTER (l_linenumber = 6) AS not_finite FROM lineitem""")
def attribution_valid(spark, folder):
    df, _ = _attributed(spark, folder)
    spoiled = df.withColumn("attribution", F.when(F.col("l_linenumber") == 7, F.slice("attribution", 1, 2)).when(
        F.col("l_linenumber") == 6, F.array(F.lit(0.0), F.lit(float("nan")), F.lit(1.0))).otherwise(F.col("attribution")))
    return attribution.check_attribution(spoiled, "attribution", len(NAMES))


def _boosted_scorer(spark, folder):
    df = written_table(spark, folder)
    columns = [c for c in df.columns if c not in (KEY, LABEL)]
    frame = training.training_frame(df, LABEL)
    model = training.tunable_models()["Gradient Boosting"].setMaxIter(8).setMaxDepth(3)
    fitted = training.fit_pipeline(model, columns, frame)
    return df, Scorer(fitted, {"model_name": "boosted", "optimal_threshold": 0.5, "promoted": True,
                               "input_feature_columns": columns})


@query("attribution_tree")
def attribution_tree(spark, folder):
    df, scorer = _boosted_scorer(spark, folder)
    rows, base, _ = attributed(scorer, df, (KEY,))
    gap = F.abs(F.lit(base) + attribution.array_total(F.col("attribution")) - F.col("margin"))
    return rows.select(KEY, "attribution", (gap < 1e-6).alias("additive"))


@query("explain_job")
def explain_job_query(spark, folder):
    df, scorer = baseline_scorer(spark, folder)
    made = explain_job(scorer, df, LABEL, sample=None, background=df)
    return made.importance
