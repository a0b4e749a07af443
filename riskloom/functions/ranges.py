"""Exact order statistics and running totals without sorting a whole column in one task.

One path serves tables of every size. A mergeable sketch of each column, from one aggregation, proposes
values that lie near wanted ranks or cut the column into ranges of about equal size. The sketch is never
trusted: rows below and inside what it proposes are counted in the next scan, and the exact answer is read
from those counts. Counting combines on the map side, so a value held by a third of all rows is one entry.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import chunked, flat_map, local_rows, named, sql_finite, sql_missing, sql_number

ACCURACY = 10_000  # a sketched rank is off by about rows / ACCURACY
ROWS_PER_RANGE = 500_000  # what a task orders at a time
ORDERED_ROWS = 500_000  # of a bracket or an open range, what a task orders at a time
SKETCHED_ROWS = 20_000  # up to so many rows are ordered without a sketch
SPREAD = 4 / ACCURACY  # to both sides of a wanted fraction
CHILDREN = 32  # a range that is too large is cut into so many
SPAN = 4 * CHILDREN  # a range's number is its parent's times SPAN and its place there
COLUMNS_PER_SCAN = 50


def locate(df: DataFrame, columns: Mapping[str, Sequence[float]], suffix: str) -> DataFrame:
    """Add ``<column><suffix>``: how many cut points lie at or below the value (binary search)."""
    cut = {c: list(points) for c, points in columns.items()}
    searched = [c for c in cut if cut[c]]
    kept = [named(c) for c in df.columns]
    if searched:
        df = Bucketizer(
            splitsArray=[[-math.inf, *cut[c], math.inf] for c in searched],
            inputCols=searched, outputCols=[c + suffix for c in searched], handleInvalid="keep",
        ).transform(df)
    return df.select(*kept, *[
        F.expr(f"CAST({c}{suffix} AS INT) AS {c}{suffix}" if c in searched else f"0 AS {c}{suffix}") for c in cut])


_PROFILE = {"missing": "count_if(gone{0})", "n": "count(x{0})", "low": "min(x{0})", "high": "max(x{0})",
            "mean": "avg(x{0})", "std": "stddev_pop(x{0})"}


def _profiled(df: DataFrame, part: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    return df.selectExpr(*[f"{sql_finite(df, c)} AS x{i}" for i, c in enumerate(part)],
                         *[f"{sql_missing(df, c)} AS gone{i}" for i, c in enumerate(part)], *extra)


def _profile_plan(width: int, kept: Sequence[str]) -> list[Column]:
    return [F.expr("count(1) AS `rows`"), *[
        F.expr(f"{_PROFILE[k].format(i)} AS {k}{i}") for i in range(width) for k in kept]]


def column_profile(df: DataFrame, columns: Sequence[str], moments: bool = True) -> dict[str, dict]:
    """Row, null and finite counts and range of every column; mean and population deviation on request."""
    profile: dict[str, dict] = {}
    kept = list(_PROFILE)[:6 if moments else 4]
    for part in chunked(list(columns), 100):
        row = _profiled(df, part).agg(*_profile_plan(len(part), kept)).first()
        for i, c in enumerate(part):
            profile[c] = {"rows": row["rows"], **{k: row[f"{k}{i}"] for k in kept}}
    return profile


def paired_profile(reference: DataFrame, current: DataFrame, columns: Sequence[str], moments: bool = True
                   ) -> tuple[dict[str, dict], dict[str, dict]]:
    """The profiles of two batches from one grouped aggregation."""
    profiles: tuple[dict, dict] = ({}, {})
    kept = list(_PROFILE)[:6 if moments else 4]
    for part in chunked(list(columns), 100):
        both = _profiled(reference, part, ["0 AS side"]).unionByName(_profiled(current, part, ["1 AS side"]))
        rows = {r["side"]: r for r in both.groupBy("side").agg(*_profile_plan(len(part), kept)).collect()}
        for side, profile in enumerate(profiles):
            for i, c in enumerate(part):
                if side in rows:
                    profile[c] = {"rows": rows[side]["rows"], **{k: rows[side][f"{k}{i}"] for k in kept}}
                else:
                    profile[c] = {"rows": 0, "missing": 0, "n": 0, **dict.fromkeys(kept[2:])}
    return profiles


def sketched(df: DataFrame, fractions: Mapping[str, Sequence[float]], accuracy: int = ACCURACY) -> dict[str, list[float]]:
    """Values near the given fractions of each column, from one combining aggregation; empty for an empty column."""
    out: dict[str, list[float]] = {}
    for part in chunked(list(fractions), COLUMNS_PER_SCAN):
        base = df.selectExpr(*[f"{sql_finite(df, c)} AS x{i}" for i, c in enumerate(part)])
        row = base.selectExpr(*[
            f"percentile_approx(x{i}, array({', '.join(sql_number(p) for p in fractions[c])}), {accuracy}) AS q{i}"
            for i, c in enumerate(part)]).first()
        out.update({c: list(row[f"q{i}"] or []) for i, c in enumerate(part)})
    return out


def balanced_cuts(df: DataFrame, ranges: Mapping[str, int]) -> dict[str, list[float]]:
    """Strictly increasing cut points that leave about equally many rows between them."""
    found = sketched(df, {c: [i / n for i in range(1, n)] for c, n in ranges.items() if n > 1})
    return {c: sorted(set(found.get(c, []))) for c in ranges}


def range_cuts(df: DataFrame, value: str, keys: Sequence[str] = (), rows_per_range: int | None = None) -> list[float]:
    """Cut points for ordering a column range by range, for each key apart: no key has more than about
    ``rows_per_range`` rows with different values between two of them.

    One aggregation counts the rows of every key and proposes its cuts; the cut points of all keys together cut each
    key at least as finely as its own. At least as many ranges as the session has shuffle partitions, more for more
    rows. Where a sketch cannot tell ranges of that size apart, the ranges that are too large propose cuts of their
    own, and so on.
    """
    rows_per_range = rows_per_range or ROWS_PER_RANGE
    least = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    fine = min(ACCURACY // 2, 8 * least)
    levels = ", ".join(sql_number(i / fine) for i in range(1, fine))
    cells = df.select(*[named(k) for k in keys], F.expr(sql_finite(df, value)).alias("x")).filter("x IS NOT NULL")
    probes = cells.groupBy(*[named(k) for k in keys]).agg(
        F.count("x").alias("n"), F.expr(f"percentile_approx(x, array({levels}), {ACCURACY})").alias("q")).collect()
    points: set[float] = set()
    widest = 0.0
    for probe in (r for r in probes if r["n"]):
        ranges = min(fine, max(2, math.ceil(least / len(probes)), math.ceil(probe["n"] / rows_per_range)))
        points.update(probe["q"][i * fine // ranges - 1] for i in range(1, ranges))
        widest = max(widest, probe["n"] / ranges + 2 * probe["n"] / ACCURACY)
    while widest > 1.5 * rows_per_range:
        inner = ", ".join(sql_number(i / CHILDREN) for i in range(1, CHILDREN))
        large = locate(cells, {"x": sorted(points)}, "_at").groupBy(*[named(k) for k in keys], "x_at").agg(
            F.count("x").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"),
            F.expr(f"percentile_approx(x, array({inner}), {ACCURACY})").alias("q")
        ).filter((F.col("n") > rows_per_range) & (F.col("low") < F.col("high"))).select("low", "q").collect()
        for r in large:  # at most rows / rows_per_range of them; a value that fills a range gets one of its own
            points.update({v for v in r["q"] if v > r["low"]} or {math.nextafter(r["low"], math.inf)})
        if not large:
            break
    return sorted(points)


def _merged(intervals: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


@dataclasses.dataclass(frozen=True)
class Bracket:
    """Between two values, both outside, lie ``rows`` rows; ``ranks`` are sought there."""

    low: float
    high: float
    rows: int
    ranks: tuple[int, ...]
    below: int = 0  # rows up to and with ``low``
    missed: bool = False  # an earlier attempt did not hold all ranks


def _propose(df: DataFrame, brackets: Sequence[tuple[str, Bracket]]) -> list[list[tuple[float, float]]]:
    """Per bracket, values around each of its ranks: two fractions of the sketch of the bracket's own rows."""
    if not brackets:
        return []
    inside, wanted = [], {}
    for i, (c, b) in enumerate(brackets):
        x = sql_finite(df, c)
        open_ = b.low == -math.inf and b.high == math.inf
        inside.append(f"{x} AS b{i}" if open_ else f"CASE WHEN {x} > {sql_number(b.low)} AND {x} < {sql_number(b.high)} THEN {x} END AS b{i}")
        near = [(k - b.below + 0.5) / b.rows for k in b.ranks]
        wanted[f"b{i}"] = [min(max(p + d, 0.0), 1.0) for p in near for d in (-SPREAD, SPREAD)]
    values = sketched(df.selectExpr(*inside), wanted)
    out = []
    for i, (_, b) in enumerate(brackets):
        pairs = list(zip(values[f"b{i}"][0::2], values[f"b{i}"][1::2]))
        near = zip(wanted[f"b{i}"][0::2], wanted[f"b{i}"][1::2])
        out.append([(b.low if p <= 0 else float(v), b.high if q >= 1 else float(w)) for (v, w), (p, q) in zip(pairs, near)])
    return out


def values_inside(df: DataFrame, intervals: Mapping[str, Sequence[tuple[float, float]]]) -> DataFrame:
    """``(c, j, x, rows)`` for the columns in their order: the rows of each value in the closed interval 2j+1, and those
    between two intervals together (``x`` NULL). What is grouped and ordered is one entry a value."""
    cuts = {f"x{i}": [v for a, b in own for v in (a, math.nextafter(b, math.inf))] for i, own in enumerate(intervals.values())}
    base = df.selectExpr(*[f"{sql_finite(df, c)} AS x{i}" for i, c in enumerate(intervals)])
    base = locate(base, {c: [v for v in own if math.isfinite(v)] for c, own in cuts.items()}, "_at")  # a binary search
    structs = []
    for i, own in enumerate(cuts.values()):
        j = f"(x{i}_at + {int(own[0] == -math.inf)})"
        structs.append(F.expr(f"CASE WHEN x{i} IS NOT NULL AND {j} < {len(own)} THEN "
                              f"named_struct('c', {i}, 'j', {j}, 'x', CASE WHEN {j} % 2 = 1 THEN x{i} END) END"))
    places = [F.coalesce(k, F.lit(0)).alias(k) for k in ("c", "j")]  # never NULL: one scan serves both uses in _read
    return flat_map(base, structs).select(*places, "x").groupBy("c", "j", "x").agg(F.count(F.lit(1)).alias("rows"))


def _read(df: DataFrame, intervals: Mapping[str, Sequence[tuple[float, float]]], ranks: Mapping[str, Sequence[int]]
          ) -> dict[str, dict[int, float]]:
    """The values of those ranks that lie in the intervals. Each interval is ordered apart; sums carry over."""
    names, spark = list(intervals), df.sparkSession
    counted = values_inside(df, intervals)
    earlier = Window.partitionBy("c").orderBy("j").rowsBetween(Window.unboundedPreceding, -1)
    sums = counted.groupBy("c", "j").agg(F.sum("rows").alias("rows")).select(  # one row per interval
        "c", "j", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"), "rows")
    wanted = local_rows(spark, [(i, k) for i, c in enumerate(names) for k in ranks[c]], "c int, k long")
    held = sums.join(F.broadcast(wanted), "c").filter((F.col("k") >= F.col("start")) & (F.col("k") < F.col("start") + F.col("rows")))
    through = Window.partitionBy("c", "j").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    upto = counted.withColumn("upto", F.sum("rows").over(through))  # a filter here would keep both uses from one exchange
    here = upto.join(F.broadcast(held.select("c", "j", "k", "start")), ["c", "j"])  # one row per wanted rank
    k = F.col("k") - F.col("start")
    out: dict[str, dict[int, float]] = {c: {} for c in names}
    for v in here.filter((k < F.col("upto")) & (k >= F.col("upto") - F.col("rows")) & F.col("x").isNotNull()).select("c", "k", "x").collect():
        out[names[v["c"]]][int(v["k"])] = float(v["x"])
    return out


def _narrow(df: DataFrame, cuts: Mapping[str, Sequence[float]], ranks: Mapping[str, Sequence[int]]
            ) -> tuple[dict[str, dict[int, float]], dict[str, list[Bracket]]]:
    """Count the rows at and between cut points: ranks that fall on one are found, the others get a smaller bracket."""
    base = df.selectExpr(*[f"{sql_finite(df, c)} AS x{i}" for i, c in enumerate(cuts)])
    base = locate(base, {f"x{i}": own for i, own in enumerate(cuts.values())}, "_at")
    cells = [F.expr(f"CASE WHEN x{i} IS NOT NULL THEN named_struct('c', {i}, 'at', 2 * x{i}_at - CAST(x{i}_at > 0 AND x{i} = "
                    f"array({', '.join(map(sql_number, own))})[greatest(x{i}_at - 1, 0)] AS INT)) END") for i, own in enumerate(cuts.values())]
    counts: dict[int, dict[int, int]] = {i: {} for i in range(len(cuts))}
    for r in flat_map(base, cells).groupBy("c", "at").agg(F.count(F.lit(1)).alias("rows")).collect():  # two per cut point
        counts[r["c"]][r["at"]] = r["rows"]
    found: dict[str, dict[int, float]] = {c: {} for c in cuts}
    left: dict[str, list[Bracket]] = {c: [] for c in cuts}
    for i, (c, own) in enumerate(cuts.items()):
        places = sorted(counts[i])
        ends = np.cumsum([counts[i][p] for p in places])
        at = np.searchsorted(ends, ranks[c], side="right")
        for n in sorted(set(at.tolist())):
            inside, place = tuple(k for k, m in zip(ranks[c], at) if m == n), places[n]
            if place % 2:
                found[c] |= dict.fromkeys(inside, own[place // 2])
            else:
                edge = place // 2
                left[c].append(Bracket(own[edge - 1] if edge else -math.inf, own[edge] if edge < len(own) else math.inf,
                                       counts[i][place], inside, int(ends[n]) - counts[i][place]))
    return found, left


def order_statistics(df: DataFrame, ranks: Mapping[str, Sequence[int]], profile: Mapping[str, dict],
                     ordered_rows: int | None = None) -> dict[str, dict[int, float]]:
    """The values at the given 0-based ranks of the non-null values of each column, by nested brackets.

    A sketch of a bracket's rows proposes an interval around each rank. Intervals of at most ``ordered_rows`` rows are
    ordered value by value, each in a task of its own; larger ones become brackets once the rows at and between their
    ends are counted, and are sketched anew. What a task orders is bounded at any size: a level divides the rows by
    about a thousand. A rank that an interval does not hold is sought again in a counted bracket.
    """
    limit = ordered_rows or ORDERED_ROWS
    found: dict[str, dict[int, float]] = {c: {} for c in ranks}
    open_ = {c: [Bracket(-math.inf, math.inf, profile[c]["n"], tuple(sorted(set(ks))))] for c, ks in ranks.items() if profile[c]["n"] and ks}
    while open_:
        for part in chunked(list(open_), COLUMNS_PER_SCAN):
            read: dict[str, list[tuple[float, float]]] = {}
            cut: dict[str, set[float]] = {}
            sketchy = [(c, b) for c in part for b in open_[c] if b.rows > min(limit, SKETCHED_ROWS)]
            proposed = dict(zip(sketchy, _propose(df, sketchy)))
            for c, b in ((c, b) for c in part for b in open_[c]):
                intervals = _merged(proposed.get((c, b), [(b.low, b.high)]))
                rows = b.rows if (c, b) not in proposed else b.rows * (2 * SPREAD + 2 / ACCURACY) * len(b.ranks) / len(intervals)
                if rows <= limit and not b.missed:
                    read.setdefault(c, []).extend(intervals)
                else:
                    cut.setdefault(c, set()).update(v for pair in intervals for v in pair if b.low < v < b.high)
            todo = {c: [b for b in open_.pop(c)] for c in part}
            sought = {c: [k for b in own for k in b.ranks] for c, own in todo.items()}
            if read:
                for c, values in _read(df, {c: _merged(own) for c, own in read.items()}, sought).items():
                    found[c] |= values
            again = {c: [k for k in own if k not in found[c]] for c, own in sought.items()}
            narrowing = {c: sorted(cut[c]) for c in part if again[c] and cut.get(c)}
            if narrowing:
                points, left = _narrow(df, narrowing, again)
                for c, own in left.items():
                    found[c] |= points[c]
                    if own:
                        open_[c] = own
            for c in part:  # what an interval missed, in the next round by counting
                if again[c] and c not in narrowing:
                    open_[c] = [dataclasses.replace(b, ranks=tuple(k for k in b.ranks if k in again[c]), missed=True)
                                for b in todo[c] if any(k in again[c] for k in b.ranks)]
    return found


def quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]], profile: Mapping[str, dict] | None = None) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation between neighbours; NULL for an empty column."""
    profile = profile or column_profile(df, list(wanted), moments=False)
    place = {c: [(profile[c]["n"] - 1) * p for p in ps] for c, ps in wanted.items() if profile[c]["n"]}
    ranks = {c: sorted({r for h in hs for r in (math.floor(h), math.ceil(h))}) for c, hs in place.items()}
    values = order_statistics(df, ranks, profile) if ranks else {}
    out: dict[str, list[float | None]] = {c: [None] * len(ps) for c, ps in wanted.items()}
    for c, hs in place.items():
        for i, h in enumerate(hs):
            below, above = values[c][math.floor(h)], values[c][math.ceil(h)]
            out[c][i] = below + (above - below) * (h - math.floor(h))
    return out


def running_totals(df: DataFrame, value: str, measures: Mapping[str, Column], keys: Sequence[str] = (),
                   descending: bool = False, rows_per_range: int | None = None) -> DataFrame:
    """Per distinct value: its measures, their running sums ``cum_*`` and grand sums ``all_*``.

    Rows meet first by value, so ties and hot values collapse before anything is ordered. The
    ordering then runs inside ranges that are balanced for each key; their starting totals come from the range sums.
    """
    cuts = range_cuts(df, value, keys, rows_per_range)
    cells = df.select(*[named(k) for k in keys], F.expr(sql_finite(df, value)).alias("value"),
                      *[expr.alias(m) for m, expr in measures.items()]).filter(F.col("value").isNotNull())
    group = [*keys, "value_at"]
    located = locate(cells, {"value": cuts}, "_at").withColumn("value_at", F.coalesce("value_at", F.lit(0)))  # never NULL: one scan serves both sides
    counted = located.groupBy(*group, "value").agg(*[F.sum(m).alias(m) for m in measures])
    totals = counted.groupBy(*group).agg(*[F.sum(m).alias(m) for m in measures])
    order, place = (F.col(c).desc() if descending else F.col(c).asc() for c in ("value", "value_at"))
    through = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(  # one row per key and range
        *group,
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"off_{m}") for m in measures],
        *[F.sum(m).over(Window.partitionBy(*keys)).alias(f"all_{m}") for m in measures],
    )
    return counted.join(offsets, group).select(
        *keys, F.col("value"), *measures,
        *[(F.sum(m).over(through) + F.col(f"off_{m}")).alias(f"cum_{m}") for m in measures],
        *[F.col(f"all_{m}") for m in measures],
    )


def _gaps(own, whole: Mapping[str, float], start: Mapping[str, np.ndarray], best: float):
    """Of consecutive ranges with counts ``ref`` and ``cur``: the largest gap at their ends, and for each range the
    largest that its rows could make inside, with the counts before it."""
    upto = {k: start[k] + own[k].cumsum().to_numpy() for k in whole}
    before = {k: upto[k] - own[k].to_numpy() for k in whole}
    best = max(best, float(np.abs(upto["ref"] / whole["ref"] - upto["cur"] / whole["cur"]).max(initial=0.0)))
    reach = np.maximum(upto["ref"] / whole["ref"] - before["cur"] / whole["cur"], upto["cur"] / whole["cur"] - before["ref"] / whole["ref"])
    return best, reach, before


def largest_gaps(df: DataFrame, columns: Sequence[str], side: str, profile: Mapping[str, dict],
                 ordered_rows: int | None = None) -> dict[str, float]:
    """Largest distance between the two cumulative distributions of each column (side 0 vs 1), by branch and bound.

    The distance is known exactly at every range end. A range can beat the best of those only if its own rows suffice
    to. Such a range of more than ``ordered_rows`` rows is cut into CHILDREN by a sketch of its own rows, at and between
    the cut points, again and again; the others are grouped by value in the end, each ordered by one task.
    """
    limit, spark = ordered_rows or ORDERED_ROWS, df.sparkSession
    best = {c: 0.0 for c in columns if profile[c]["n"]}
    sides = [F.count_if(F.col("side") == 0).alias("ref"), F.count_if(F.col("side") == 1).alias("cur")]
    several = (F.min("x") < F.max("x")).alias("several")  # one value has no inside
    for part in chunked(list(best), COLUMNS_PER_SCAN):
        ranges = {c: max(16, min(ACCURACY // 5, profile[c]["n"] // 1000)) for c in part}
        cuts = balanced_cuts(df, ranges)
        base = df.select(*[F.expr(f"{sql_finite(df, c)} AS x{i}") for i, c in enumerate(part)], named(side).alias("side"))
        base = locate(base, {f"x{i}": cuts[c] for i, c in enumerate(part)}, "_at")
        cells = flat_map(base, [F.expr(f"CASE WHEN x{i} IS NOT NULL THEN named_struct('c', {i}, 'r', x{i}_at, 'x', x{i}) END")
                                for i in range(len(part))], [F.col("side")])
        whole: dict[int, dict[str, float]] = {}
        levels: list[tuple[DataFrame, list[tuple]]] = []
        counts, parents = cells.groupBy("c", "r").agg(*sides, several).toPandas(), None
        while True:
            opened = []
            for key, own in counts.groupby("c" if parents is None else ["c", "parent"]):
                i, node = (key, None) if parents is None else key
                own = own.sort_values("r")
                if node is None:
                    whole[i] = {k: max(float(own[k].sum()), 1.0) for k in ("ref", "cur")}
                start = dict.fromkeys(("ref", "cur"), 0) if node is None else dict(zip(("ref", "cur"), parents[i, node]))
                c = part[i]
                best[c], reach, before = _gaps(own, whole[i], start, best[c])
                for n in np.flatnonzero(own["several"]):
                    opened.append((int(i), node, int(own["r"].iloc[n]), int(before["ref"][n]), int(before["cur"][n]),
                                   int(own["ref"].iloc[n] + own["cur"].iloc[n]), float(reach[n])))
            opened = [o for o in opened if o[-1] > best[part[o[0]]]]
            small = [(i, r if node is None else node * SPAN + r, a, b, rows, reach) for i, node, r, a, b, rows, reach in opened if rows <= limit]
            large = [(i, r if node is None else node * SPAN + r, a, b, rows, reach) for i, node, r, a, b, rows, reach in opened if rows > limit]
            levels.append((cells, small))
            if not large:
                break
            numbered = {(i, r): n for n, (i, r, *_) in enumerate(large)}
            parents = {(i, n): large[n][2:4] for (i, _), n in numbered.items()}
            within = cells.join(local_rows(spark, [(i, r, n) for (i, r), n in numbered.items()], "c int, r int, node int"), ["c", "r"])
            inner = ", ".join(sql_number(n / CHILDREN) for n in range(1, CHILDREN))
            found = within.groupBy("node").agg(F.expr(f"array_distinct(percentile_approx(x, array({inner}), {ACCURACY}))").alias("cuts")).collect()
            known = local_rows(spark, [(n, list(cuts_)) for n, cuts_ in found], "node int, cuts array<double>")
            place = F.expr("2 * size(filter(cuts, v -> v < x)) + CAST(array_contains(cuts, x) AS INT)")
            cells = within.drop("r").join(known, "node").select("c", "node", (F.col("node") * SPAN + place).alias("r"), "x", "side")
            counts = cells.groupBy("c", F.col("node").alias("parent"), F.expr(f"r - node * {SPAN}").alias("r")).agg(*sides, several).toPandas()
            cells = cells.drop("node")
        values = None
        for at, small in levels:  # what the best gap so far leaves open
            left = [o for o in small if o[-1] > best[part[o[0]]]]
            if not left:
                continue
            nodes = local_rows(spark, [(i, r, a, b) for i, r, a, b, *_ in left], "c int, r int, ref0 long, cur0 long")
            own = at.join(nodes, ["c", "r"]).groupBy("c", "r", "ref0", "cur0", "x").agg(*sides)
            through = Window.partitionBy("c", "r").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
            own = own.select("c", *[(F.sum(k).over(through) + F.col(f"{k}0")).alias(k) for k in ("ref", "cur")])
            values = own if values is None else values.unionByName(own)
        if values is not None:
            totals = local_rows(spark, [(i, w["ref"], w["cur"]) for i, w in whole.items()], "c int, n_ref double, n_cur double")
            gap = F.max(F.abs(F.col("ref") / F.col("n_ref") - F.col("cur") / F.col("n_cur")))
            for row in values.join(F.broadcast(totals), "c").groupBy("c").agg(gap.alias("gap")).collect():  # one row per column
                best[part[row["c"]]] = max(best[part[row["c"]]], float(row["gap"]))
    return best
