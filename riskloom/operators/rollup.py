"""One-to-many rollups and the applicant feature table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import named, numeric_columns


def rollup(df: DataFrame, key: str, prefix: str) -> DataFrame:
    """One row per key: min, max, mean and sum of each numeric column, non-null count of the first.

    All five combine map-side, so a key that owns a third of the rows still arrives as one partial
    row per task. NULL keys are left out; the sum of an all-NULL group is 0, not NULL.
    """
    measured = numeric_columns(df, exclude=[key])
    present = df.filter(named(key).isNotNull())
    if not measured:
        return present.select(named(key)).distinct()
    plan = []
    for i, c in enumerate(measured):
        x, name = named(c), f"{prefix}_{c}"
        plan += [F.min(x).alias(f"{name}_min"), F.max(x).alias(f"{name}_max"), F.avg(x).alias(f"{name}_mean"),
                 F.coalesce(F.sum(x), F.lit(0)).alias(f"{name}_sum")]
        if i == 0:
            plan.append(F.count(x).alias(f"{name}_count"))
    return present.groupBy(named(key)).agg(*plan)


def two_level_rollup(parent: DataFrame, child: DataFrame, child_key: str, parent_key: str,
                     child_prefix: str, parent_prefix: str) -> DataFrame:
    """Roll the grandchild up to the child, join it, then roll the child up to the parent key."""
    return rollup(parent.join(rollup(child, child_key, child_prefix), child_key, "left"), parent_key, parent_prefix)


def attach(base: DataFrame, rolled: DataFrame, key: str) -> DataFrame:
    return base.join(rolled, key, "left")


@dataclass(frozen=True)
class ChildTable:
    table: str
    prefix: str
    nested: str | None = None
    nested_key: str | None = None
    nested_prefix: str | None = None


# The child tables of an applicant and the prefixes of their features.
CREDIT_CHILDREN = (
    ChildTable("bureau", "bureau", "bureau_balance", "SK_ID_BUREAU", "bb"),
    ChildTable("previous_application", "prev"),
    ChildTable("pos_cash", "pos"),
    ChildTable("credit_card", "cc"),
    ChildTable("installments", "inst"),
)


def child_rollups(tables: Mapping[str, DataFrame], key: str = "SK_ID_CURR",
                  children: tuple[ChildTable, ...] = CREDIT_CHILDREN) -> list[DataFrame]:
    out = []
    for c in children:
        if c.nested:
            out.append(two_level_rollup(tables[c.table], tables[c.nested], c.nested_key, key, c.nested_prefix, c.prefix))
        else:
            out.append(rollup(tables[c.table], key, c.prefix))
    return out


def feature_table(tables: Mapping[str, DataFrame], application: str = "application_train", key: str = "SK_ID_CURR",
                  children: tuple[ChildTable, ...] = CREDIT_CHILDREN,
                  rollups: list[DataFrame] | None = None) -> DataFrame:
    """Applicants with every child rollup joined on.

    Each rollup leaves its aggregation hash-partitioned by the key, so the joins line up on it and
    only the applicants move. Pass ``rollups`` read back from a written table to build the training
    and the scoring table from the same aggregates.
    """
    if application not in tables:
        raise ValueError(f"unknown applicant table {application!r}; loaded: {sorted(tables)}")
    out = tables[application]
    for rolled in rollups if rollups is not None else child_rollups(tables, key, children):
        out = attach(out, rolled, key)
    return out
