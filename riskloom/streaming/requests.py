"""Scoring requests as they arrive: the batch lookup run as a stream-static join.

Stateless, so there is no watermark. Requests whose id has no features go to a second sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import named
from riskloom.operators.scoring import Scorer


def score_stream(scorer: Scorer, requests: DataFrame, features: DataFrame, position: str = "request_pos") -> DataFrame:
    """Requests with a probability and class; unknown ids keep NULLs so that no request vanishes."""
    key = scorer.deployment.id_column
    known = features.withColumn("known", F.lit(True))
    joined = requests.select(named(key), named(position)).join(known, key, "left")
    scored = scorer.scored(joined, (position, key, "known"), check_rows=False)
    seen = F.coalesce(F.col("known"), F.lit(False))
    return scored.select(position, key, F.when(seen, F.col("DEFAULT_PROBABILITY")).alias("DEFAULT_PROBABILITY"),
                         F.when(seen, F.col("PREDICTED_CLASS")).alias("PREDICTED_CLASS"))


def run_scoring(scorer: Scorer, requests: DataFrame, features: DataFrame, output: str, checkpoint: str):
    """Append Parquet with a checkpoint, which makes restarts after a lost executor exactly-once."""
    return (score_stream(scorer, requests, features).writeStream.outputMode("append").format("parquet")
            .option("path", output).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
