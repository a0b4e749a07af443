"""Lending-domain features as one projection; a feature appears when its inputs do."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import named, ratio
from riskloom.operators.cleaning import UNEMPLOYED_DAYS, without_sentinel

# Smoothing of denominators, days per year and weights of the external scores.
EPSILON = 1e-6
YEAR = 365.25
SCORE_WEIGHTS = {"EXT_SOURCE_1": 0.25, "EXT_SOURCE_2": 0.50, "EXT_SOURCE_3": 0.25}


def row_mean(columns: Sequence[Column]) -> Column:
    return F.try_divide(row_sum(columns), row_count(columns))


def row_count(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in columns])


def row_sum(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns])


def row_std(columns: Sequence[Column]) -> Column:
    """Sample deviation over the present values of a row; NULL with fewer than two."""
    n, mean = row_count(columns), row_mean(columns)
    squares = reduce(lambda a, b: a + b, [F.coalesce((c - mean) * (c - mean), F.lit(0.0)) for c in columns])
    return F.when(n >= 2, F.sqrt(squares / (n - 1)))


def weighted_score(columns: Mapping[str, Column], weights: Mapping[str, float]) -> Column:
    """NULL if any part is; the divisor depends on which columns exist, not on which are filled."""
    total = sum(weights[c] for c in columns)
    return reduce(lambda a, b: a + b, [col * F.lit(weights[c]) for c, col in columns.items()]) / F.lit(total)


def domain_expressions(present: Sequence[str]) -> dict[str, Column]:
    has = set(present)
    annuity, income, credit = named("AMT_ANNUITY"), named("AMT_INCOME_TOTAL"), named("AMT_CREDIT")
    goods, family, birth = named("AMT_GOODS_PRICE"), named("CNT_FAM_MEMBERS"), named("DAYS_BIRTH")
    employed = without_sentinel(named("DAYS_EMPLOYED"), UNEMPLOYED_DAYS)
    rules: list[tuple[set[str], dict[str, Column]]] = [
        ({"AMT_ANNUITY", "AMT_INCOME_TOTAL"}, {"DEBT_BURDEN_RATIO": ratio(annuity, income, EPSILON)}),
        ({"AMT_CREDIT", "AMT_INCOME_TOTAL"}, {"CREDIT_INCOME_RATIO": ratio(credit, income, EPSILON)}),
        ({"AMT_ANNUITY", "AMT_CREDIT"}, {"ANNUITY_CREDIT_RATIO": ratio(annuity, credit, EPSILON),
                                         "PAYMENT_RATE": ratio(annuity, credit, EPSILON)}),
        ({"AMT_GOODS_PRICE", "AMT_CREDIT"}, {"GOODS_CREDIT_RATIO": ratio(goods, credit, EPSILON),
                                             "CREDIT_GOODS_DIFF": credit - goods}),
        ({"DAYS_BIRTH"}, {"AGE_YEARS": -birth / F.lit(YEAR)}),
        ({"DAYS_EMPLOYED"}, {"DAYS_EMPLOYED_CLEAN": employed, "YEARS_EMPLOYED": -employed / F.lit(YEAR)}),
        ({"DAYS_BIRTH", "DAYS_EMPLOYED"}, {"EMPLOYMENT_LIFE_FRACTION": ratio(-employed, -birth, EPSILON)}),
        ({"DAYS_REGISTRATION"}, {"YEARS_SINCE_REGISTRATION": -named("DAYS_REGISTRATION") / F.lit(YEAR)}),
        ({"DAYS_ID_PUBLISH"}, {"YEARS_SINCE_ID_CHANGE": -named("DAYS_ID_PUBLISH") / F.lit(YEAR)}),
    ]
    scores = {c: named(c) for c in SCORE_WEIGHTS if c in has}
    if len(scores) >= 2:
        parts = list(scores.values())
        low, high = F.least(*parts), F.greatest(*parts)
        rules.append((set(scores), {
            "EXT_SOURCE_MEAN": row_mean(parts), "EXT_SOURCE_SUM": row_sum(parts), "EXT_SOURCE_MIN": low,
            "EXT_SOURCE_MAX": high, "EXT_SOURCE_STD": row_std(parts), "EXT_SOURCE_RANGE": high - low,
            "EXT_SOURCE_WEIGHTED": weighted_score(scores, SCORE_WEIGHTS)}))
    rules += [
        ({"CNT_FAM_MEMBERS", "AMT_INCOME_TOTAL"}, {"INCOME_PER_PERSON": ratio(income, family, EPSILON)}),
        ({"CNT_FAM_MEMBERS", "AMT_CREDIT"}, {"CREDIT_PER_PERSON": ratio(credit, family, EPSILON)}),
    ]
    return {name: e for needs, made in rules if needs <= has for name, e in made.items()}


def add_domain_features(df: DataFrame) -> DataFrame:
    made = domain_expressions(df.columns)
    return df.select(*[named(c) for c in df.columns if c not in made], *[e.alias(c) for c, e in made.items()])
