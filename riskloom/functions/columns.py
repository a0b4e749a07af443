"""Column helpers shared by the operators; everything here compiles to JVM expressions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def named(name: str) -> Column:
    """Refer to a column whose name may hold dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def chunked(items: Sequence, size: int) -> Iterator[list]:
    for start in range(0, len(items), size):
        yield list(items[start:start + size])


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in skip]


def other_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if not is_numeric(f.dataType) and f.name not in skip]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Spark treats NaN as a value; the operators here treat it as missing."""
    fractional = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not fractional:
        return df
    return df.select(*[
        F.when(~F.isnan(named(c)), named(c)).alias(c) if c in fractional else named(c) for c in df.columns
    ])


def finite(column: Column) -> Column:
    """Coerce to double; text that is no number, NaN and both infinities become NULL.

    Spark orders NaN above infinity, so one comparison rules out all three.
    """
    value = column.try_cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def ratio(numerator: Column, denominator: Column, epsilon: float = 0.0) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double") + F.lit(epsilon))


def share(numerator: Column, denominator: Column, otherwise: Column | float | None = None) -> Column:
    """``numerator / denominator`` with a stated value where the denominator is zero."""
    fallback = otherwise if isinstance(otherwise, Column) else F.lit(otherwise).cast("double")
    return F.when(denominator != 0, numerator / denominator).otherwise(fallback)


def count_if(condition: Column) -> Column:
    return F.count_if(condition)


# Plans over hundreds of columns are written as SQL text: one call into the JVM per column instead
# of one per operator, which would dominate the run time of small tables.
def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_number(value: float) -> str:
    return f"double('{value}')" if value in (float("inf"), float("-inf")) else f"{float(value)!r}D"


def sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_finite(df: DataFrame, name: str) -> str:
    """SQL form of :func:`finite` for a column of a table, without tests its type makes pointless."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        return f"CAST({quoted(name)} AS DOUBLE)"
    value = f"try_cast({quoted(name)} AS DOUBLE)"
    return f"CASE WHEN abs({value}) < double('infinity') THEN {value} END"


def sql_missing(df: DataFrame, name: str) -> str:
    cell = quoted(name)
    fractional = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return f"({cell} IS NULL OR isnan({cell}))" if fractional else f"({cell} IS NULL)"


def row_hash(key: Column | str, seed: int | str) -> Column:
    """Hex digest of ``key|seed``: the same on every run, engine and partitioning."""
    column = named(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws("|", column.cast("string"), F.lit(str(seed))).cast("binary"))


def unit_interval(key: Column | str, seed: int | str) -> Column:
    """A reproducible uniform number in [0, 1) drawn from the row's own key."""
    return F.conv(F.substring(row_hash(key, seed), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def flat_map(df: DataFrame, structs: Sequence[Column], carry: Sequence[Column] = ()) -> DataFrame:
    """One output row per non-null struct; a single struct needs no generator."""
    if len(structs) == 1:
        cell = df.select(structs[0].alias("cell"), *carry)
    else:
        cell = df.select(F.explode(F.array(*structs)).alias("cell"), *carry)
    kept = [c for c in cell.columns if c != "cell"]
    return cell.filter(F.col("cell").isNotNull()).select("cell.*", *kept)


def category_cells(columns: Sequence[str], key: str = "feature", value: str = "value", keep_missing: bool = False
                   ) -> list[Column]:
    """One struct ``(column name, value as text)`` per column; NULL where the value is, unless kept."""
    cells = {c: f"named_struct('{key}', {sql_string(c)}, '{value}', CAST({quoted(c)} AS STRING))" for c in columns}
    return [F.expr(e if keep_missing else f"CASE WHEN {quoted(c)} IS NOT NULL THEN {e} END") for c, e in cells.items()]


def local_rows(spark: SparkSession, rows: Sequence[Sequence], schema: str | T.StructType) -> DataFrame:
    """A small table held by the driver, as a local relation whose size the optimizer knows."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return spark.createDataFrame(
        pa.Table.from_arrays([pa.array(list(values), type=to_arrow_type(f.dataType))
                              for values, f in zip(columns, fields)], names=fields.names), schema=fields)
