"""Path-dependent Shapley values of a Spark ML tree ensemble, as a job over the scored table.

A leaf contributes to a feature j on its path  value * (o_j - z_j) * integral over t in [0, 1] of
prod over the other features i of (z_i (1 - t) + o_i t),  where z is the share of training weight
that follows the path at the feature's splits and o says whether the row does. The integrand is a
polynomial, so Gauss-Legendre quadrature is exact. Rows are handled as arrays, batch by batch.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.columns import chunked, named
from riskloom.session import shared_folder
from riskloom.sources.sinks import write_parquet


#: Leaves that one broadcast holds; some hundred bytes each.
LEAVES_PER_PASS = 200_000

# One root-to-leaf path: (leaf value, distinct features, low, high, weight share), the last four
# aligned arrays; the row follows the path at a feature when its value lies in (low, high].
Leaf = tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def ensemble_leaves(spark: SparkSession, model: Model) -> tuple[list[Leaf], float]:
    """(leaves with tree weights applied, expected output), read from the saved model's node table."""
    folder = shared_folder(spark, "ensemble")
    model.write().overwrite().save(folder)
    nodes = spark.read.parquet(f"{folder}/data")
    if "nodeData" in nodes.columns:
        nodes = nodes.select("treeID", "nodeData.*")
    else:
        nodes = nodes.withColumn("treeID", F.lit(0))
    forest = hasattr(model, "trees") and model.numClasses == 2 and "RandomForest" in type(model).__name__
    weights = model.treeWeights if hasattr(model, "treeWeights") else [1.0]
    total = sum(weights)
    scale = [w / total if forest else w for w in weights]
    leaves: list[Leaf] = []
    base = 0.0
    by_class = forest or not hasattr(model, "trees")
    for tree, rows in nodes.toPandas().groupby("treeID"):  # bounded by the size of the model
        table = {r.id: r for r in rows.itertuples()}

        def output(node) -> float:
            if by_class:
                stats = np.asarray(node.impurityStats, float)
                return float(stats[1] / stats.sum())
            return float(node.prediction)

        def walk(at: int, path: dict[int, tuple[float, float, float]], reach: float) -> None:
            nonlocal base
            node = table[at]
            if node.leftChild < 0:
                value = scale[tree] * output(node)
                base += reach * value
                ids = sorted(path)
                leaves.append((value, np.array(ids, int), *[np.array([path[i][k] for i in ids], float)
                                                            for k in range(3)]))
                return
            split = node.split
            feature = int(split["featureIndex"])
            threshold = float(split["leftCategoriesOrThreshold"][0])
            if split["numCategories"] != -1:
                raise ValueError("splits on indexed categories are not produced by this library's pipelines")
            low, high, share = path.get(feature, (-np.inf, np.inf, 1.0))
            for child, bounds in ((node.leftChild, (low, min(high, threshold))),
                                  (node.rightChild, (max(low, threshold), high))):
                part = float(table[child].rawCount) / float(node.rawCount)
                walk(child, {**path, feature: (*bounds, share * part)}, reach * part)

        walk(0, {}, 1.0)
    return leaves, base


def shapley_values(x: np.ndarray, leaves: list[Leaf]) -> np.ndarray:
    """Attributions for a block of rows, shape (rows, features)."""
    out = np.zeros_like(x, dtype=float)
    deepest = max((len(leaf[1]) for leaf in leaves), default=1)
    nodes = {d: np.polynomial.legendre.leggauss(max(1, (d + 1) // 2)) for d in range(1, deepest + 1)}
    for value, features, low, high, share in leaves:
        if len(features) == 0:
            continue
        inside = x[:, features]
        follows = ((inside > low) & (inside <= high)).astype(float)
        points, weights = nodes[len(features)]
        effect = np.zeros_like(follows)
        for point, weight in zip((points + 1) / 2, weights / 2):
            factors = share * (1 - point) + follows * point
            effect += weight * factors.prod(axis=1, keepdims=True) / factors
        np.add.at(out.T, features, (value * (follows - share) * effect).T)
    return out


def tree_attribution(df: DataFrame, model: Model, features: str = "features", output: str = "attribution",
                     leaves_per_pass: int = LEAVES_PER_PASS) -> tuple[DataFrame, float]:
    """Add the attribution array to every row; returns the base value beside it.

    Boosted trees are explained in raw-score space, forests in probability space. Attributions add up over leaves, so a
    large ensemble is worked off in passes: each sends a bounded number of leaves to the tasks and adds to the sums,
    which are written between passes.
    """
    spark = df.sparkSession
    leaves, base = ensemble_leaves(spark, model)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have the package
    out = df.withColumn(output, F.lit(None).cast("array<double>"))
    passes = list(chunked(leaves, leaves_per_pass)) or [[]]
    for n, own in enumerate(passes):
        if n:
            out = spark.read.parquet(write_parquet(out, shared_folder(spark, "attribution-pass")))
        out = out.withColumn(output, _adding(spark.sparkContext.broadcast(own))(vector_to_array(named(features)), named(output)))
    return out, base


def _adding(shipped):
    @F.pandas_udf("array<double>")
    def attribute(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for batch, so_far in batches:
            if len(batch) == 0:
                yield pd.Series([], dtype=object)
                continue
            made = shapley_values(np.stack(batch.to_numpy()), shipped.value)
            yield pd.Series(list(made if so_far.isna().all() else made + np.stack(so_far.to_numpy())))
    return attribute
