"""Rule-based cleaning of the applicant table.

The statistics (modes, quantile caps, columns to drop) are fitted once as plain values; applying
them is one projection, so cleaning another table with the same rules costs no further pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import flat_map, named
from riskloom.functions.ranges import quantiles
from riskloom.operators.quality import high_missing_columns

# Column names, sentinel and labels of the public credit tables.
DAY_COLUMNS = ("DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_REGISTRATION", "DAYS_ID_PUBLISH", "DAYS_LAST_PHONE_CHANGE")
UNEMPLOYED_DAYS = 365243


@dataclass(frozen=True)
class CleaningRules:
    sentinel_column: str = "DAYS_EMPLOYED"
    sentinel: float = UNEMPLOYED_DAYS
    flag_column: str = "DAYS_EMPLOYED_ANOM"
    sign_columns: tuple[str, ...] = DAY_COLUMNS
    code_column: str = "CODE_GENDER"
    code: str = "XNA"
    fill_column: str = "OCCUPATION_TYPE"
    fill_flagged: str = "Not_Employed"
    fill_other: str = "Unknown"
    quantile_column: str = "AMT_INCOME_TOTAL"
    quantile: float = 0.999
    cap_column: str = "CNT_CHILDREN"
    cap: float = 10
    missing_limit: float = 0.70
    protected: tuple[str, ...] = ("EXT_SOURCE_1",)


def without_sentinel(c: Column, sentinel: float) -> Column:
    return F.when(c == F.lit(sentinel), None).otherwise(c)


def sentinel_flag(c: Column, sentinel: float) -> Column:
    return F.coalesce((c == F.lit(sentinel)).cast("int"), F.lit(0))


def positive_days(c: Column) -> Column:
    return F.abs(c)


def replaced_code(c: Column, code: str, mode: str | None) -> Column:
    return c if mode is None else F.when(c == F.lit(code), F.lit(mode)).otherwise(c)


def filled_by_flag(c: Column, flag: Column, flagged: str, other: str) -> Column:
    return F.when(c.isNull() & (flag == 1), F.lit(flagged)).when(c.isNull() & (flag == 0), F.lit(other)).otherwise(c)


def capped(c: Column, cap: Column | float | None) -> Column:
    """``least`` ignores NULL and would return the cap, so missing values are kept apart."""
    if cap is None:
        return c
    limit = cap if isinstance(cap, Column) else F.lit(cap)
    return F.when(c.isNotNull(), F.least(c, limit))


def modes(df: DataFrame, values: dict[str, Column]) -> dict[str, str | None]:
    """Most frequent value per expression, the smallest one among ties.

    Grouped counts spread over tasks, where ``mode`` would hold every distinct value in one buffer.
    """
    cells = [F.when(v.isNotNull(), F.struct(F.lit(name).alias("name"), v.cast("string").alias("value")))
             for name, v in values.items()]
    counts = flat_map(df, cells).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("name").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode")).collect()
    return {**dict.fromkeys(values), **{r["name"]: r["mode"] for r in best}}


@dataclass
class Cleaner:
    """Fitted cleaning: ``Cleaner().fit(train).transform(any_table)``."""

    rules: CleaningRules = field(default_factory=CleaningRules)
    drop_high_missing: bool = True
    mode: str | None = None
    cap: float | None = None
    dropped: tuple[str, ...] = ()

    def fit(self, df: DataFrame) -> Cleaner:
        r = self.rules
        if r.code_column in df.columns:
            code = named(r.code_column)
            self.mode = modes(df, {"mode": F.when(code != F.lit(r.code), code)})["mode"]
        if r.quantile_column in df.columns:
            self.cap = quantiles(df, {r.quantile_column: [r.quantile]})[r.quantile_column][0]
        if self.drop_high_missing:
            self.dropped = tuple(high_missing_columns(self._projected(df), r.missing_limit, r.protected))
        return self

    def _projected(self, df: DataFrame) -> DataFrame:
        r = self.rules
        new: dict[str, Column] = {c: named(c) for c in df.columns}
        flag = None
        if r.sentinel_column in new:
            flag = sentinel_flag(named(r.sentinel_column), r.sentinel)
            new[r.sentinel_column] = without_sentinel(named(r.sentinel_column), r.sentinel)
            new[r.flag_column] = flag
        for c in r.sign_columns:
            if c in new:
                new[c] = positive_days(new[c])
        if r.code_column in new:
            new[r.code_column] = replaced_code(named(r.code_column), r.code, self.mode)
        if r.fill_column in new and flag is not None:
            new[r.fill_column] = filled_by_flag(named(r.fill_column), flag, r.fill_flagged, r.fill_other)
        if r.quantile_column in new:
            new[r.quantile_column] = capped(named(r.quantile_column), self.cap)
        if r.cap_column in new:
            new[r.cap_column] = capped(named(r.cap_column), r.cap)
        return df.select(*[e.alias(c) for c, e in new.items()])

    def transform(self, df: DataFrame) -> DataFrame:
        return self._projected(df).drop(*self.dropped)


def clean_applications(df: DataFrame, rules: CleaningRules | None = None, drop_high_missing: bool = True) -> DataFrame:
    return Cleaner(rules or CleaningRules(), drop_high_missing).fit(df).transform(df)


def drop_quietly(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop what is there; absent names are no error."""
    return df.drop(*columns)
