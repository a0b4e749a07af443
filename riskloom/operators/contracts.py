"""Data contracts. Each check yields rows ``(table_name, check, column_name, n)``; none means it holds.

A table costs one aggregation for emptiness, key nulls and the label, and one grouped count for key
uniqueness. The strict wrappers collect those few rows and raise one error naming all of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.columns import count_if, finite, local_rows, named

VIOLATIONS = "table_name string, check string, column_name string, n long"


class ContractViolation(ValueError):
    """All problems found in one pass."""


@dataclass(frozen=True)
class TableContract:
    required: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    unique: str | None = None
    label: str | None = None
    optional: bool = False


# Minimum columns, join keys and one-row-per-key columns of the credit tables.
_BY_PREVIOUS = TableContract(("SK_ID_CURR", "SK_ID_PREV"), ("SK_ID_CURR", "SK_ID_PREV"))
_APPLICANT = ("SK_ID_CURR", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY")
CREDIT_TABLES: dict[str, TableContract] = {
    "application_train": TableContract((*_APPLICANT, "TARGET"), ("SK_ID_CURR",), "SK_ID_CURR", "TARGET"),
    "application_test": TableContract(_APPLICANT, ("SK_ID_CURR",), "SK_ID_CURR", optional=True),
    "bureau": TableContract(("SK_ID_CURR", "SK_ID_BUREAU"), ("SK_ID_CURR", "SK_ID_BUREAU")),
    "bureau_balance": TableContract(("SK_ID_BUREAU",), ("SK_ID_BUREAU",)),
    "previous_application": _BY_PREVIOUS,
    "pos_cash": _BY_PREVIOUS,
    "credit_card": _BY_PREVIOUS,
    "installments": _BY_PREVIOUS,
}


def inference_contracts(contracts: Mapping[str, TableContract] = CREDIT_TABLES,
                        application: str = "application_test") -> dict[str, TableContract]:
    """The same tables without the labelled applicants: scoring needs no label and must not ask for one."""
    return {
        name: replace(c, label=None, optional=False) for name, c in contracts.items()
        if c.label is None or name == application
    }


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def extra_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(expected)]


#: The name under which row counts travel with the checks.
ROWS = "rows"


def _violation(table: str, check: str, column: str | None, n: Column) -> Column:
    return F.struct(F.lit(table).alias("table_name"), F.lit(check).alias("check"),
                    F.lit(column).cast("string").alias("column_name"), n.cast("long").alias("n"))


def _known(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return local_rows(spark, rows, VIOLATIONS)


def _unfold(summary: DataFrame, checks: Sequence[Column]) -> DataFrame:
    return summary.select(F.inline(F.array(*checks))).filter("n > 0")


def aggregate_checks(df: DataFrame, table: str, keys: Sequence[str] = (), label: str | None = None,
                     with_rows: bool = False) -> DataFrame:
    """Emptiness, key nulls and label domain out of a single aggregation; on request also the row count, as check ``rows``."""
    plan, checks = [F.count(F.lit(1)).alias("rows")], [
        _violation(table, "empty", None, F.when(F.col("rows") == 0, 1).otherwise(0))]
    for i, key in enumerate(keys):
        plan.append(count_if(named(key).isNull()).alias(f"null{i}"))
        checks.append(_violation(table, "key_null", key, F.col(f"null{i}")))
    if label is not None:
        y = named(label).try_cast("double")
        plan += [count_if(named(label).isNull()).alias("label_null"),
                 count_if(named(label).isNotNull() & ~F.coalesce(y.isin(0.0, 1.0), F.lit(False))).alias("label_bad"),
                 F.min(y).alias("label_low"), F.max(y).alias("label_high")]
        single = (F.col("rows") > 0) & (F.col("label_bad") == 0) & (
            F.col("label_low").eqNullSafe(F.col("label_high")))
        checks += [_violation(table, "label_null", label, F.col("label_null")),
                   _violation(table, "label_domain", label, F.col("label_bad")),
                   _violation(table, "label_single_class", label, F.when(single, 1).otherwise(0))]
    if with_rows:
        checks.append(_violation(table, ROWS, None, F.col("rows")))
    return _unfold(df.agg(*plan), checks)


def check_empty(df: DataFrame, table: str) -> DataFrame:
    return aggregate_checks(df, table)


def check_key_nulls(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    return aggregate_checks(df, table, keys).filter("check = 'key_null'")


def check_label(df: DataFrame, table: str, label: str) -> DataFrame:
    if label not in df.columns:
        return _known(df.sparkSession, [(table, "label_missing", label, 1)])
    return aggregate_checks(df, table, (), label).filter("check like 'label%'")


def check_key_unique(df: DataFrame, table: str, key: str | Sequence[str]) -> DataFrame:
    """Surplus rows per key, as rows minus distinct keys. Counts combine before they shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    surplus = df.groupBy(*[named(k) for k in keys]).agg(F.count(F.lit(1)).alias("held")).agg(
        F.sum(F.col("held") - 1).alias("n"))
    return surplus.select(F.lit(table).alias("table_name"), F.lit("key_duplicate").alias("check"),
                          F.lit(",".join(keys)).alias("column_name"), F.col("n").cast("long").alias("n")
                          ).filter("n > 0")


def check_table(df: DataFrame, table: str, contract: TableContract, with_rows: bool = False) -> DataFrame:
    spark = df.sparkSession
    known = [(table, "column_missing", c, 1) for c in missing_columns(df, contract.required)]
    known += [(table, "key_missing", k, 1) for k in contract.keys if k not in df.columns]
    if contract.label and contract.label not in df.columns:
        known.append((table, "label_missing", contract.label, 1))
    parts = [_known(spark, known)] if known else []
    label = contract.label if contract.label in df.columns else None
    parts.append(aggregate_checks(df, table, [k for k in contract.keys if k in df.columns], label, with_rows))
    if contract.unique and contract.unique in df.columns:
        parts.append(check_key_unique(df, table, contract.unique))
    return reduce(DataFrame.unionByName, parts)


def check_tables(tables: Mapping[str, DataFrame], contracts: Mapping[str, TableContract] = CREDIT_TABLES,
                 with_rows: bool = False) -> DataFrame:
    """All violations of all tables; a required table that was not loaded is one of them."""
    parts = [check_table(df, name, contracts.get(name, TableContract()), with_rows) for name, df in tables.items()]
    absent = [(name, "table_missing", None, 1) for name, c in contracts.items()
              if name not in tables and not c.optional]
    if absent:
        spark = next(iter(tables.values())).sparkSession if tables else SparkSession.active()
        parts.append(_known(spark, absent))
    return reduce(DataFrame.unionByName, parts)


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns"))
        for name, df in tables.items()
    ])


def _refuse(rows: Sequence) -> None:
    if rows:
        lines = [f"{r['table_name']}: {r['check']}" + (f" {r['column_name']}" if r["column_name"] else "")
                 + f" (n={r['n']})" for r in rows]
        raise ContractViolation(f"{len(rows)} problem(s):\n  " + "\n  ".join(lines))


def require(violations: DataFrame) -> None:
    """Raise once, with every problem on its own line."""
    _refuse(violations.collect())  # bounded by tables x checks x columns


def _validated(tables: Mapping[str, DataFrame], contracts: Mapping[str, TableContract]) -> DataFrame:
    """The profile of tables that keep their contracts. The row counts come with the checks, not from a further scan."""
    found = check_tables(tables, contracts, with_rows=True).collect()
    _refuse([r for r in found if r["check"] != ROWS])
    counts = {r["table_name"]: r["n"] for r in found}
    spark = next(iter(tables.values())).sparkSession
    return local_rows(spark, [(name, counts.get(name, 0), len(df.columns)) for name, df in tables.items()],
                      "table_name string, n_rows long, n_columns long")


def validate_training_tables(tables: Mapping[str, DataFrame],
                             contracts: Mapping[str, TableContract] = CREDIT_TABLES) -> DataFrame:
    return _validated(tables, contracts)


def validate_inference_tables(tables: Mapping[str, DataFrame],
                              contracts: Mapping[str, TableContract] = CREDIT_TABLES,
                              application: str = "application_test") -> DataFrame:
    needed = inference_contracts(contracts, application)
    used = {name: df for name, df in tables.items() if name in needed}
    return _validated(used, needed)


def require_frame(df: DataFrame, table: str, required: Sequence[str] = ()) -> None:
    absent = missing_columns(df, required)
    if absent:
        raise ContractViolation(f"{table}: missing column(s) {absent}")
    if df.isEmpty():
        raise ContractViolation(f"{table}: no rows")


def check_probabilities(df: DataFrame, score: str, table: str = "scores") -> DataFrame:
    """A score must exist, be finite and lie in [0, 1]."""
    p = named(score).cast("double")
    summary = df.agg(
        F.count(F.lit(1)).alias("rows"), count_if(p.isNull() | F.isnan(p) | (F.abs(p) == float("inf"))).alias("odd"),
        count_if((p < 0) | ((p > 1) & ~F.isnan(p))).alias("outside"))
    return _unfold(summary, [
        _violation(table, "empty", None, F.when(F.col("rows") == 0, 1).otherwise(0)),
        _violation(table, "not_finite", score, F.col("odd")),
        _violation(table, "outside_unit_interval", score, F.col("outside"))])


def check_scored(df: DataFrame, label: str, score: str, table: str = "scored") -> DataFrame:
    """Every row needs a label of 0 or 1 and a finite score, and both classes must occur."""
    y, p = named(label), finite(named(score))
    summary = df.agg(
        F.count(F.lit(1)).alias("rows"), count_if(y.isNull()).alias("no_label"), count_if(p.isNull()).alias("no_score"),
        count_if(~y.cast("double").isin(0.0, 1.0)).alias("other"), F.min(y.cast("double")).alias("low"), F.max(y.cast("double")).alias("high"))
    return _unfold(summary, [
        _violation(table, "empty", None, F.when(F.col("rows") == 0, 1).otherwise(0)),
        _violation(table, "label_null", label, F.col("no_label")),
        _violation(table, "label_other", label, F.col("other")),
        _violation(table, "score_null", score, F.col("no_score")),
        _violation(table, "label_single_class", label,
                   F.when((F.col("rows") > 0) & F.col("low").eqNullSafe(F.col("high")), 1).otherwise(0))])
