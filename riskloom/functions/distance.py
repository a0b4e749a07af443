"""Distances between two discrete distributions kept as rows of (feature, part, ref, cur)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import sql_number

SMOOTHING = 1e-8  # fixed value: added to every part so that an empty part has a finite log ratio


def smoothed(weight: Column, total: Column, parts: Column) -> Column:
    return (weight + F.lit(SMOOTHING)) / (total + parts * F.lit(SMOOTHING))


def psi_term(p: Column, q: Column) -> Column:
    return (q - p) * F.log(q / p)


def divergence_term(p: Column, q: Column) -> Column:
    middle = (p + q) / 2
    return (p * F.log2(p / middle) + q * F.log2(q / middle)) / 2


def js_distance(divergence: Column) -> Column:
    return F.sqrt(F.greatest(divergence, F.lit(0.0)))


def distances(parts: DataFrame, keys: Sequence[str], normalise_first: bool = False,
              extra: Mapping[str, Column] | None = None) -> DataFrame:
    """PSI, Jensen-Shannon and total variation distance per key, over the parts that are not NULL.

    ``normalise_first`` smooths shares (categories) instead of counts (histogram bins). The totals,
    and any ``extra`` aggregates wanted beside the distances, come from a grouped sum of one row per
    compared column, which is broadcast back: neither a window nor a shuffle by key gathers all
    categories of a column in one task, and both readings of ``parts`` share one exchange.
    """
    extra = dict(extra or {})
    known = F.col("part").isNotNull()
    ref, cur = (F.when(known, F.col(c)).otherwise(0).cast("double") for c in ("ref", "cur"))
    total = parts.groupBy(*keys).agg(
        F.sum(ref).alias("ref_total"), F.sum(cur).alias("cur_total"),
        F.count_if(known).cast("double").alias("n_parts"), *[e.alias(name) for name, e in extra.items()])
    both = parts.join(F.broadcast(total), list(keys))  # one row per compared column
    raw_p, raw_q = F.try_divide(ref, F.col("ref_total")), F.try_divide(cur, F.col("cur_total"))
    if normalise_first:
        p, q = (smoothed(w, F.lit(1.0), F.col("n_parts")) for w in (raw_p, raw_q))
    else:
        p, q = (smoothed(w, F.col(t), F.col("n_parts")) for w, t in ((ref, "ref_total"), (cur, "cur_total")))
    filled = (F.max("ref_total") > 0) & (F.max("cur_total") > 0)
    return both.groupBy(*keys).agg(
        F.when(filled, F.sum(F.when(known, psi_term(p, q)))).alias("psi"),
        F.when(filled, js_distance(F.sum(F.when(known, divergence_term(p, q))))).alias("js"),
        F.when(filled, F.sum(F.when(known, F.abs(raw_p - raw_q))) / 2).alias("tv"),
        *[F.max(name).alias(name) for name in extra])


def bin_index(value: str, inner_edges: Sequence[float]) -> str:
    """SQL for the 0-based bin of a value, bins closed on the left; a sum of comparisons stays in codegen."""
    return " + ".join(["0", *[f"CAST({value} >= {sql_number(edge)} AS INT)" for edge in inner_edges]])
