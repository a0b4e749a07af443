"""Reproducible splits, folds, samples and drift injection.

Membership is a function of the row's key and a seed, so any job at any later time rebuilds the
same sets. Exact sizes need the key hash at a given rank; those few cut-offs are found from counts
per hash prefix plus a ranking of single prefixes, after which assigning a row needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import count_if, finite, local_rows, named, row_hash, unit_interval
from riskloom.operators.cleaning import modes

PREFIX = 4  # hex digits of the key hash that are counted: 65,536 prefixes per stratum
#: A table of so many cuts at most is broadcast; beyond it the joins shuffle.
BROADCAST_CUTS = 100_000


def _check_sizes(validation: float, test: float) -> None:
    for name, size in (("validation", validation), ("test", test)):
        if not 0.0 < size < 1.0:
            raise ValueError(f"{name} share must lie strictly between 0 and 1, got {size}")
    if validation + test >= 1.0:
        raise ValueError(f"validation and test shares leave no training rows: {validation} + {test}")


def split_by_hash(df: DataFrame, key: str, validation: float = 0.15, test: float = 0.15, seed: int = 42,
                  output: str = "split") -> DataFrame:
    """train / validation / test in one projection; sizes and class balance hold in expectation."""
    _check_sizes(validation, test)
    u = unit_interval(key, seed)
    return df.withColumn(output, F.when(u < test, F.lit("test")).when(u < test + validation, F.lit("validation"))
                         .otherwise(F.lit("train")))


def _label(stratum: str | None) -> Column:
    """The stratum as text that is never NULL; NULL rows are a stratum of their own."""
    if stratum is None:
        return F.lit("all")
    return F.when(named(stratum).isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), named(stratum).cast("string")))


def stratum_sizes(df: DataFrame, stratum: str | None) -> DataFrame:
    return df.groupBy(_label(stratum).alias("stratum")).agg(F.count(F.lit(1)).alias("n"))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_CUTS else df


def rank_cuts(df: DataFrame, key: str, seed: int, wanted: DataFrame, many: int, stratum: str | None = None) -> DataFrame:
    """For each ``(stratum, cut, k)`` of ``wanted``, ``many`` rows, the row at place k in (hash, key) order.

    Rows are counted by stratum and hash prefix; only rows of the prefixes that hold a wanted place are ordered. Returns
    ``(stratum, cut, digest, id, ties)``: rows sorting before (digest, id) come first, and of those equal to it the first
    ``ties`` still belong before the cut. A cut behind the last row is left out.
    """
    hashed = df.select(_label(stratum).alias("stratum"), named(key).alias("id"), row_hash(key, seed).alias("digest"))
    hashed = hashed.withColumn("prefix", F.substring("digest", 1, PREFIX))
    counts = hashed.groupBy("stratum", "prefix").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("stratum").orderBy("prefix"))
    held = counts.withColumn("upto", upto).join(_small(wanted, many), "stratum").filter(
        (F.col("k") < F.col("upto")) & (F.col("k") >= F.col("upto") - F.col("n")))
    held = held.select("stratum", "prefix", "cut", (F.col("k") - F.col("upto") + F.col("n") + 1).alias("place"))
    order = Window.partitionBy("stratum", "prefix").orderBy("digest", "id")
    near = hashed.join(_small(held.select("stratum", "prefix").distinct(), many), ["stratum", "prefix"], "left_semi").select(
        "*", F.row_number().over(order).alias("place"), F.rank().over(order).alias("rank"))
    return near.join(held, ["stratum", "prefix", "place"]).select(
        "stratum", "cut", "digest", "id", (F.col("place") - F.col("rank")).alias("ties"))


def _assigned(df: DataFrame, key: str, seed: int, stratum: str | None, sizes: DataFrame, ranks: Sequence[Column],
              names: Sequence, output: str) -> DataFrame:
    """The first name whose cut a row sorts before; the last name takes the rest. ``ranks`` are expressions of ``n``."""
    many = sizes.count()
    if not many:
        raise ValueError("cannot split an empty table")
    wanted = sizes.select("stratum", F.posexplode(F.array(*[r.cast("long") for r in ranks])).alias("cut", "k"))
    found = rank_cuts(df, key, seed, wanted, many * len(ranks), stratum)
    every = wanted.join(found, ["stratum", "cut"], "left").groupBy("stratum").agg(
        F.array_sort(F.collect_list(F.struct("cut", "digest", "id"))).alias("__cuts"))
    joined = df.withColumn("stratum__", _label(stratum)).withColumn("__digest", row_hash(key, seed)).join(
        _small(every.withColumnRenamed("stratum", "stratum__"), many), "stratum__", "left")
    choice = F.lit(names[-1])
    for i in reversed(range(len(ranks))):
        digest, at = F.col("__cuts")[i]["digest"], F.col("__cuts")[i]["id"]
        before = digest.isNull() | (F.col("__digest") < digest) | ((F.col("__digest") == digest) & F.coalesce(named(key) < at, F.lit(False)))
        choice = F.when(before, F.lit(names[i])).otherwise(choice)
    return joined.withColumn(output, choice).select(*[named(c) for c in df.columns if c != output], output)


def split_exact(df: DataFrame, key: str, label: str | None, validation: float = 0.15, test: float = 0.15,
                seed: int = 42, output: str = "split") -> DataFrame:
    """Stratified split whose sizes per class are exact to rounding of the *original* counts.

    Rows that share a key stay together, so with repeated keys a size may miss by the rows of one key."""
    _check_sizes(validation, test)
    sizes, n = stratum_sizes(df, label), F.col("n")
    first, second = F.floor(n * F.lit(float(test)) + 0.5), F.floor(n * F.lit(float(validation)) + 0.5)
    return _assigned(df, key, seed, label, sizes, [first, first + second], ["test", "validation", "train"], output)


def stratified_folds(df: DataFrame, key: str, label: str | None, folds: int = 3, seed: int = 42,
                     output: str = "fold") -> DataFrame:
    """Fold numbers 0..k-1; within each class fold sizes differ by at most one row (or the rows of one key)."""
    n = F.col("n")
    ranks = [F.floor(n / folds) * j + F.least(F.lit(j), n % folds) for j in range(1, folds)]
    return _assigned(df, key, seed, label, stratum_sizes(df, label), ranks, list(range(folds)), output)


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the first in hash order; among rows of the last key, the first by all columns."""
    wanted = local_rows(df.sparkSession, [("all", 0, n)], "stratum string, cut int, k long")
    cut = rank_cuts(df, key, seed, wanted, 1).first()
    if cut is None:
        return df
    digest = row_hash(key, seed)
    same = named(key).eqNullSafe(F.lit(cut["id"]))
    out = df.filter((digest < cut["digest"]) | ((digest == cut["digest"]) & F.coalesce(named(key) < F.lit(cut["id"]), F.lit(False))))
    if not cut["ties"]:
        return out
    return out.unionByName(df.filter((digest == cut["digest"]) & same).orderBy(*[named(c) for c in df.columns]).limit(cut["ties"]))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Class counts, negatives per positive, and balanced class weights ``n / (2 * class size)``."""
    y = named(label).cast("double")
    pos, neg = F.col("positives"), F.col("negatives")
    return df.agg(count_if(y == 1).alias("positives"), count_if(y == 0).alias("negatives")).select(
        "positives", "negatives", F.try_divide(neg, pos).alias("scale_pos_weight"),
        F.try_divide(pos + neg, 2 * pos).alias("weight_positive"),
        F.try_divide(pos + neg, 2 * neg).alias("weight_negative"))


@dataclass(frozen=True)
class DriftPlan:
    """What to disturb in a demonstration batch."""

    scale: Mapping[str, float]
    shift: Mapping[str, float]
    category: str | None = None
    category_share: float = 0.15
    blank: str | None = None
    blank_share: float = 0.12


# The disturbances used for the credit tables.
CREDIT_DRIFT = DriftPlan(
    scale={"AMT_INCOME_TOTAL": 1.18, "ANNUITY_CREDIT_RATIO": 1.12},
    shift={"EXT_SOURCE_MEAN": -0.35, "DAYS_BIRTH": -0.25},
    category="NAME_INCOME_TYPE", blank="EXT_SOURCE_1",
)


def inject_drift(df: DataFrame, key: str, plan: DriftPlan = CREDIT_DRIFT, seed: int = 2026
                 ) -> tuple[DataFrame, list[str]]:
    """Scale, shift by population deviations, tilt one category to its mode, blank extra values."""
    have, new = set(df.columns), {c: named(c) for c in df.columns}
    applied: list[str] = []
    shifted = [c for c in plan.shift if c in have]
    if shifted:
        spread = df.agg(*[F.stddev_pop(finite(named(c))).alias(f"s{i}") for i, c in enumerate(shifted)]).first()
        for i, c in enumerate(shifted):
            new[c] = named(c).cast("double") + F.lit(plan.shift[c]) * F.lit(spread[f"s{i}"])
    for c, factor in plan.scale.items():
        if c in have:
            new[c] = named(c).cast("double") * F.lit(factor)
    applied += [c for c in [*plan.scale, *plan.shift] if c in have]
    if plan.category in have:
        top = modes(df, {"mode": named(plan.category)})["mode"]
        if top is not None:
            new[plan.category] = F.when(unit_interval(key, f"{seed}|category") < plan.category_share, F.lit(top)
                                        ).otherwise(named(plan.category))
            applied.append(plan.category)
    if plan.blank in have:
        new[plan.blank] = F.when(unit_interval(key, f"{seed}|blank") >= plan.blank_share, new[plan.blank])
        applied.append(f"{plan.blank} (missing rate)")
    return df.select(*[e.alias(c) for c, e in new.items()]), applied
