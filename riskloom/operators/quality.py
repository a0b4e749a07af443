"""Column statistics that describe a table or decide which columns stay."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.columns import chunked, count_if, named

# The inclusive bounds of the narrower integer types, narrowest first.
INTEGER_BOUNDS = (("tinyint", -128, 127), ("smallint", -32768, 32767), ("int", -2147483648, 2147483647))


def null_shares(df: DataFrame) -> dict[str, float]:
    """Share of NULL per column, in one aggregation per hundred columns."""
    shares: dict[str, float] = {}
    for part in chunked(df.columns, 100):
        row = df.agg(*[F.avg(named(c).isNull().cast("double")).alias(f"s{i}") for i, c in enumerate(part)]).first()
        shares.update({c: row[f"s{i}"] or 0.0 for i, c in enumerate(part)})
    return shares


def high_missing_columns(df: DataFrame, limit: float = 0.70, protected: Iterable[str] = ("EXT_SOURCE_1",)) -> list[str]:
    keep = set(protected)
    return [c for c, share in null_shares(df).items() if share > limit and c not in keep]


def low_information_columns(df: DataFrame, id_col: str = "SK_ID_CURR", target_col: str = "TARGET",
                            id_marker: str = "SK_ID") -> list[str]:
    """Columns holding at most one distinct value, plus key columns other than id and target.

    Equal smallest and largest value says "at most one" without counting distinct values.
    """
    dropped = {c for c in df.columns if id_marker in c and c not in {id_col, target_col}}
    for part in chunked(df.columns, 100):
        row = df.agg(*[F.min(named(c)).eqNullSafe(F.max(named(c))).alias(f"k{i}") for i, c in enumerate(part)]).first()
        dropped |= {c for i, c in enumerate(part) if row[f"k{i}"]}
    return sorted(dropped)


def drop_low_information(df: DataFrame, id_col: str = "SK_ID_CURR", target_col: str = "TARGET",
                         id_marker: str = "SK_ID") -> tuple[DataFrame, list[str]]:
    dropped = low_information_columns(df, id_col, target_col, id_marker)
    return df.drop(*dropped), dropped


def narrowed_types(df: DataFrame) -> dict[str, str]:
    """Smallest integer type that holds the observed range; doubles become floats."""
    wide = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.LongType, T.IntegerType))]
    target = {f.name: "float" for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    for part in chunked(wide, 100):
        row = df.agg(*[e for i, c in enumerate(part)
                       for e in (F.min(named(c)).alias(f"a{i}"), F.max(named(c)).alias(f"b{i}"))]).first()
        for i, c in enumerate(part):
            low, high = row[f"a{i}"], row[f"b{i}"]
            fit = next((t for t, a, b in INTEGER_BOUNDS if low is not None and low >= a and high <= b), None)
            if fit:
                target[c] = fit
    return target


def narrow_types(df: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    types = types if types is not None else narrowed_types(df)
    return df.select(*[named(c).cast(types[c]).alias(c) if c in types else named(c) for c in df.columns])


def _row_fingerprint(df: DataFrame) -> list[Column]:
    """128 bits per row. Spark's hash skips NULLs, so their positions are hashed as well."""
    cells = [named(c) for c in df.columns]
    nulls = F.concat(*[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cells])
    return [F.xxhash64(nulls, *cells).alias("h1"), F.xxhash64(F.lit(1), *reversed(cells), nulls).alias("h2")]


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows minus distinct rows, told apart by 128 bits per row: only those move, never whole rows."""
    groups = df.select(*_row_fingerprint(df)).groupBy("h1", "h2")
    return groups.agg(F.count(F.lit(1)).alias("held")).agg(
        F.coalesce(F.sum(F.col("held") - 1), F.lit(0)).cast("long").alias("n"))


def missing_profile(df: DataFrame) -> DataFrame:
    """NULL count and percentage of the columns that have any, most affected first."""
    rows = F.col("rows")
    counts = df.agg(F.count(F.lit(1)).alias("rows"),
                    *[count_if(named(c).isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)])
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("missing_count"),
                      (F.try_divide(F.col(f"m{i}"), rows) * 100).alias("missing_pct"))
             for i, c in enumerate(df.columns)]
    return counts.select(F.inline(F.array(*cells))).filter("missing_count > 0").orderBy(
        F.desc("missing_pct"), "column_name")


def quality_profile(df: DataFrame) -> DataFrame:
    """Long report ``(section, item, value)``: shape, duplicate rows, type histogram, missing values."""
    kinds: dict[str, int] = {}
    for f in df.schema.fields:
        kinds[f.dataType.simpleString()] = kinds.get(f.dataType.simpleString(), 0) + 1
    counts = df.agg(F.count(F.lit(1)).alias("rows"),
                    *[count_if(named(c).isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)])

    def cell(section: str, item: str, value: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), F.lit(item).alias("item"),
                        value.cast("double").alias("value"))

    cells = [cell("shape", "rows", F.col("rows")), cell("shape", "columns", F.lit(len(df.columns)))]
    cells += [cell("dtype", k, F.lit(n)) for k, n in sorted(kinds.items())]
    for i, c in enumerate(df.columns):
        some = F.col(f"m{i}") > 0
        cells += [F.when(some, cell("missing_count", c, F.col(f"m{i}"))),
                  F.when(some, cell("missing_pct", c, F.try_divide(F.col(f"m{i}"), F.col("rows")) * 100))]
    report = counts.select(F.explode(F.array_compact(F.array(*cells))).alias("r")).select("r.*")
    twins = duplicate_rows(df).select(
        F.lit("duplicates").alias("section"), F.lit("rows").alias("item"), F.col("n").cast("double").alias("value"))
    return report.unionByName(twins)
