"""Batch scoring of a feature table with the saved champion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators.scoring import Scorer
from riskloom.sources.sinks import write_csv


def predict_job(spark: SparkSession, champion_folder: str, features: DataFrame, output: str | None = None,
                allow_unpromoted: bool = False) -> DataFrame:
    """One row per applicant: id, probability, class at the frozen threshold."""
    predictions = Scorer.load(spark, champion_folder, allow_unpromoted).predict(features)
    if output:
        write_csv(predictions, output)
    return predictions
