"""Explanations of the champion over rows it was not fitted on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import named
from riskloom.operators.attribution import (
    additivity, background_means, explain_rows, importance, linear_attribution, linear_base, local_examples)
from riskloom.operators.sampling import sample_rows
from riskloom.operators.scores import threshold_class
from riskloom.operators.scoring import Scorer, UnusableModel
from riskloom.operators.training import with_score
from riskloom.operators.tree_attribution import tree_attribution
from riskloom.session import shared_folder
from riskloom.sources.sinks import write_parquet


@dataclass
class Explanation:
    rows: DataFrame
    base: float
    names: list[str]
    output_space: str
    importance: DataFrame
    examples: DataFrame
    additivity: DataFrame | None


def attributed(scorer: Scorer, df: DataFrame, keep: tuple[str, ...], background: DataFrame | None = None
               ) -> tuple[DataFrame, float, str]:
    """Rows with ``values``, ``attribution``, ``margin`` and ``score``; base value; output space."""
    preprocessor, model = scorer.preprocessor, scorer.model.stages[-1]
    names = preprocessor.output_names()
    rows = model.transform(preprocessor.transform(preprocessor.align(df, keep)))
    rows = with_score(rows).withColumn("values", vector_to_array(F.col("features")))
    if len(names) != model.numFeatures:
        raise UnusableModel(f"{model.numFeatures} model inputs but {len(names)} feature names")
    if isinstance(model, LogisticRegressionModel):
        if background is None:
            raise UnusableModel("a linear explanation needs background rows")
        exprs = preprocessor.expressions()
        means = background_means(background, exprs)
        weights = [float(w) for w in model.coefficients]
        values = [F.col("values")[i] for i in range(len(names))]
        rows = rows.withColumn("attribution", linear_attribution(values, weights, [means[n] for n in names]))
        base, space = linear_base(weights, [means[n] for n in names], model.intercept), "margin"
        margin = vector_to_array(F.col("rawPrediction"))[1]
    else:
        rows, base = tree_attribution(rows, model)
        boosted = isinstance(model, GBTClassificationModel)
        space = "margin" if boosted else "probability"
        margin = vector_to_array(F.col("rawPrediction"))[1] if boosted else F.col("score")
    return rows.withColumn("margin", margin).select(
        *[named(k) for k in keep], "values", "attribution", "margin", "score"), base, space


def explain_job(scorer: Scorer, df: DataFrame, label: str | None = None, sample: int | None = None,
                background_size: int | None = None, background: DataFrame | None = None, examples: int = 5, top_n: int = 10,
                seed: int = 42) -> Explanation:
    """Transform, attribute, rank, choose rows worth reading. All rows are explained against all rows unless a
    ``sample`` or a ``background_size`` is asked for."""
    key = scorer.deployment.id_column
    rows = df if sample is None else sample_rows(df, key, sample, seed)
    around = background if background is not None else df
    if background is None and background_size is not None:
        around = sample_rows(df, key, background_size, seed + 1)
    keep = (key, label) if label and label in df.columns else (key,)
    made, base, space = attributed(scorer, rows, keep, scorer.preprocessor.align(around))
    # the ranking, the examples and the check all read the attributions, so they are computed once
    made = df.sparkSession.read.parquet(write_parquet(made, shared_folder(df.sparkSession, "attributions")))
    names = scorer.preprocessor.output_names()
    threshold = scorer.deployment.optimal_threshold
    picks = local_examples(made, key, "score", threshold, examples, label if len(keep) > 1 else None)
    local = explain_rows(made.join(F.broadcast(picks), key), "attribution", "values", names, top_n)  # at most `examples`
    hit = threshold_class(F.col("score"), threshold)
    local = local.withColumn("predicted_class", hit).withColumn("threshold", F.lit(float(threshold))).withColumn(
        "actual_class", named(label) if len(keep) > 1 else F.lit(None).cast("int"))
    local = local.withColumn("base_value", F.lit(base)).withColumn("output_space", F.lit(space)).drop(
        "values", "attribution").orderBy("position")
    check = additivity(made, "attribution", F.lit(base), "margin")
    return Explanation(made, base, names, space, importance(made, "attribution", names), local, check)
