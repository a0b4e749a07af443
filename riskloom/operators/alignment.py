"""Bringing a table to the column layout a model was fitted on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import named
from riskloom.operators.contracts import missing_columns


class SchemaMismatch(ValueError):
    """The input lacks what the model was fitted on."""


def align_lenient(df: DataFrame, expected: Sequence[str], types: Mapping[str, str] | None = None) -> DataFrame:
    """Absent columns become NULL, surplus columns go, order follows the model. One projection."""
    have = set(df.columns)
    kinds = types or {}
    return df.select(*[named(c) if c in have else F.lit(None).cast(kinds.get(c, "double")).alias(c) for c in expected])


def align_strict(df: DataFrame, expected: Sequence[str], keep: Sequence[str] = (), check_rows: bool = True) -> DataFrame:
    """Absent columns or an empty input are errors; otherwise drop and reorder, carrying ``keep``."""
    absent = [c for c in expected if c in set(missing_columns(df, expected))]
    if absent:
        shown = ", ".join(absent[:10]) + (" ..." if len(absent) > 10 else "")
        raise SchemaMismatch(f"{len(absent)} column(s) the model was fitted on are missing: {shown}")
    if check_rows and df.isEmpty():
        raise SchemaMismatch("the input has no rows")
    return df.select(*[named(c) for c in keep if c not in set(expected)], *[named(c) for c in expected])
