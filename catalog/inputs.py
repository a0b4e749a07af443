"""Inputs derived from the given tables, once as Spark columns and once as SQL.

The expressions are plain SQL that both engines read alike, so each is written a single time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import table

APPLICANT = {
    "SK_ID_CURR": "c_custkey",
    "TARGET": "CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END",
    "AMT_INCOME_TOTAL": "c_acctbal + 1000",
    "AMT_CREDIT": "1000e0 + (c_custkey % 9973) * 7.5e0",
    "AMT_ANNUITY": "100e0 + (c_custkey % 613) * 1.25e0",
    "AMT_GOODS_PRICE": "900e0 + (c_custkey % 7919) * 7e0",
    "CNT_FAM_MEMBERS": "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 1 + c_custkey % 5 END",
    "CNT_CHILDREN": "c_custkey % 17",
    "DAYS_BIRTH": "-(7000 + c_custkey % 18000)",
    "DAYS_EMPLOYED": "CASE WHEN c_custkey % 6 = 0 THEN 365243 ELSE -(c_custkey % 5000) - 100 END",
    "DAYS_REGISTRATION": "-(c_custkey % 9001)",
    "DAYS_ID_PUBLISH": "-(c_custkey % 4001)",
    "CODE_GENDER": "CASE WHEN c_custkey % 250 = 3 THEN 'XNA' WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END",
    "OCCUPATION_TYPE": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END",
    "NAME_INCOME_TYPE": "c_mktsegment",
    "EXT_SOURCE_1": "CASE WHEN c_custkey % 4 = 1 THEN (c_custkey % 97) / 97e0 END",
    "EXT_SOURCE_2": "(c_custkey % 89) / 89e0",
    "EXT_SOURCE_3": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE (c_custkey % 83) / 83e0 END",
    "OWN_CAR_AGE": "CASE WHEN c_custkey % 10 = 0 THEN c_custkey % 40 END",
    "FLAG_MOBIL": "1",
}
APPLICANT_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in APPLICANT.items()) + " FROM customer"


def applicant(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(*[f"{e} AS {c}" for c, e in APPLICANT.items()])


# scored rows: many ties, all in [0, 1]
SCORED = {
    "p": "round(l_discount * l_quantity / 5, 2)",
    "y": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
    "l_linestatus": "l_linestatus",
    "l_returnflag": "l_returnflag",
    "late": "CASE WHEN l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' THEN 1 ELSE 0 END",
}
SCORED_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in SCORED.items()) + " FROM lineitem"


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(*[f"{e} AS {c}" for c, e in SCORED.items()])


# orders with a key, a score, a label and groups
RATED = {
    "o_orderkey": "o_orderkey",
    "p": "round(o_totalprice / 600000, 4)",
    "y": "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END",
    "o_orderstatus": "o_orderstatus",
    "o_orderpriority": "o_orderpriority",
}
RATED_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in RATED.items()) + " FROM orders"


def rated(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(*[f"{e} AS {c}" for c, e in RATED.items()])


# reference and current batch: lineitem before and from 1998 on, the second with changes
NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "gap", "flat"]
CATEGORICAL = ["l_returnflag", "l_linestatus", "mode"]
BATCH_COLUMNS = NUMERIC + CATEGORICAL
_SAME = {c: c for c in ("l_extendedprice", "l_discount", "l_returnflag", "l_linestatus")}
REFERENCE = {
    **_SAME, "l_quantity": "l_quantity", "l_tax": "l_tax",
    "gap": "CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE l_tax * 100 + l_linenumber END", "flat": "1e0",
    "mode": "CASE WHEN l_linenumber > 5 THEN NULL WHEN l_linenumber % 2 = 0 THEN 'A' ELSE 'B' END",
}
CURRENT = {
    **_SAME, "l_quantity": "l_quantity * 1.04e0", "l_tax": "l_tax * l_tax * 12",
    "gap": "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_tax * 100 + l_linenumber END", "flat": "1e0",
    "mode": "CASE WHEN l_linenumber > 5 THEN NULL WHEN l_linenumber = 3 THEN 'C' WHEN l_linenumber % 2 = 0 "
            "THEN 'A' ELSE 'B' END",
}
_EARLY, _LATE = "l_shipdate < TIMESTAMP '1998-01-01 00:00:00'", "l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'"
BATCHES_SQL = ", ".join(
    f"{name} AS (SELECT " + ", ".join(f"{made[c]} AS {c}" for c in BATCH_COLUMNS) + f" FROM lineitem WHERE {cond})"
    for name, made, cond in (("ref", REFERENCE, _EARLY), ("cur", CURRENT, _LATE)))


def batches(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, folder, "lineitem")
    return tuple(rows.filter(cond).selectExpr(*[f"{made[c]} AS {c}" for c in BATCH_COLUMNS])
                 for made, cond in ((REFERENCE, _EARLY), (CURRENT, _LATE)))


# credit-style tables: applicants, two child tables, one grandchild table
def credit_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    orders, items, events = (table(spark, folder, n) for n in ("orders", "lineitem", "events"))
    return {
        "application_train": applicant(spark, folder).select("SK_ID_CURR", "TARGET", "AMT_INCOME_TOTAL", "AMT_CREDIT",
                                                            "AMT_ANNUITY"),
        "bureau": orders.select(F.col("o_custkey").alias("SK_ID_CURR"), F.col("o_orderkey").alias("SK_ID_BUREAU"),
                                F.floor("o_totalprice").cast("double").alias("AMT"), "o_orderstatus"),
        "bureau_balance": items.select(F.col("l_orderkey").alias("SK_ID_BUREAU"), F.col("l_quantity").alias("QTY"),
                                       F.floor(F.col("l_extendedprice") / 100).cast("double").alias("PRICE"), "l_returnflag"),
        "previous_application": events.select(F.col("user_id").alias("SK_ID_CURR"), F.floor("value").cast("double").alias("VALUE"),
                                              "event_type"),
    }
