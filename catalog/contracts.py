"""Data contracts on tables that break them in known ways."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import applicant, rated, scored, RATED_SQL, SCORED_SQL
from catalog.registry import query, rounded, table
from riskloom.operators import contracts

_V = "{t!r} AS table_name, {c!r} AS \"check\", {col} AS column_name, {n} AS n"


def _row(t: str, check: str, column: str | None, n: str, source: str, where: str = "n > 0") -> str:
    col = f"'{column}'" if column else "NULL::VARCHAR"
    return (f"SELECT '{t}' AS table_name, '{check}' AS \"check\", {col} AS column_name, n FROM "
            f"(SELECT ({n})::BIGINT AS n FROM {source}) WHERE {where}")


@query("check_empty", _row("void", "empty", None, "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END",
                           "(SELECT * FROM customer WHERE c_acctbal < -99999)"))
def check_empty(spark, folder):
    none = contracts.check_empty(table(spark, folder, "customer").filter("c_acctbal < -99999"), "void")
    return none.unionByName(contracts.check_empty(table(spark, folder, "customer"), "customer"))


@query("check_label", " UNION ALL ".join([
    _row("orders", "label_null", "y", "count(*) FILTER (o_orderkey % 50 = 0)", "orders"),
    _row("orders", "label_domain", "y", "count(*) FILTER (o_orderkey % 50 <> 0 AND o_orderstatus = 'P')", "orders"),
    _row("flat", "label_single_class", "y", "1", "(SELECT 1)")]))
def check_label(spark, folder):
    orders = table(spark, folder, "orders").withColumn("y", F.expr(
        "CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderstatus = 'P' THEN 2 WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END"))
    flat = table(spark, folder, "customer").withColumn("y", F.lit(1))
    return contracts.check_label(orders, "orders", "y").unionByName(contracts.check_label(flat, "flat", "y"))


@query("check_key_nulls", _row("orders", "key_null", "cust", "count(*) FILTER (o_custkey % 13 = 0)", "orders"))
def check_key_nulls(spark, folder):
    df = table(spark, folder, "orders").withColumn("cust", F.expr("CASE WHEN o_custkey % 13 = 0 THEN NULL ELSE o_custkey END"))
    return contracts.check_key_nulls(df, "orders", ["o_orderkey", "cust"])


@query("check_key_unique", _row("lineitem", "key_duplicate", "l_orderkey,l_linenumber",
                                "sum(k - 1)", "(SELECT count(*) AS k FROM lineitem GROUP BY l_orderkey, l_linenumber)"))
def check_key_unique(spark, folder):
    twice = contracts.check_key_unique(table(spark, folder, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"])
    return twice.unionByName(contracts.check_key_unique(table(spark, folder, "orders"), "orders", "o_orderkey"))


SPEC = {
    "customer": contracts.TableContract(("SK_ID_CURR", "TARGET", "AMT_INCOME_TOTAL", "REGION"), ("SK_ID_CURR",), "SK_ID_CURR", "TARGET"),
    "customer_new": contracts.TableContract(("SK_ID_CURR",), ("SK_ID_CURR",), "SK_ID_CURR", optional=True),
    "orders": contracts.TableContract(("o_custkey", "o_orderkey"), ("o_custkey", "o_orderkey")),
    "lineitem": contracts.TableContract(("l_orderkey",), ("l_orderkey", "l_linenumber"), "l_orderkey"),
    "cards": contracts.TableContract(("id",), ("id",)),
}


def _spoiled(spark, folder):
    return {
        "customer": applicant(spark, folder),
        "orders": table(spark, folder, "orders").withColumn(
            "o_custkey", F.expr("CASE WHEN o_custkey % 13 = 0 THEN NULL ELSE o_custkey END")),
        "lineitem": table(spark, folder, "lineitem"),
    }


_FIXED = "SELECT '{}' AS table_name, '{}' AS \"check\", {} AS column_name, 1::BIGINT AS n"
_BROKEN = [
    _row("orders", "key_null", "o_custkey", "count(*) FILTER (o_custkey % 13 = 0)", "orders"),
    _row("lineitem", "key_duplicate", "l_orderkey", "sum(k - 1)", "(SELECT count(*) AS k FROM lineitem GROUP BY l_orderkey)"),
    _FIXED.format("cards", "table_missing", "NULL::VARCHAR"),
]


@query("contract_training", " UNION ALL ".join([_FIXED.format("customer", "column_missing", "'REGION'"), *_BROKEN]))
def contract_training(spark, folder):
    return contracts.check_tables(_spoiled(spark, folder), SPEC)


@query("contract_inference", " UNION ALL ".join(_BROKEN))
def contract_inference(spark, folder):
    tables = _spoiled(spark, folder)
    tables["customer_new"] = tables.pop("customer").drop("TARGET")
    return contracts.check_tables(tables, contracts.inference_contracts(SPEC, "customer_new"))


@query("check_probabilities", " UNION ALL ".join([
    _row("orders", "not_finite", "q", "count(*) FILTER (o_orderkey % 100 = 0)", "orders"),
    _row("orders", "outside_unit_interval", "q", "count(*) FILTER (o_orderkey % 100 <> 0 AND o_totalprice / 400000 > 1)", "orders")]))
def check_probabilities(spark, folder):
    bad = table(spark, folder, "orders").withColumn("q", F.expr(
        "CASE WHEN o_orderkey % 100 = 0 THEN NULL ELSE o_totalprice / 400000 END"))
    return contracts.check_probabilities(bad, "q", "orders").unionByName(
        contracts.check_probabilities(rated(spark, folder), "p", "rated"))


@query("check_scored", " UNION ALL ".join([
    _row("orders", "label_null", "late_y", "count(*) FILTER (o_orderstatus = 'P')", "orders"),
    _row("odd", "label_other", "y", "count(*) FILTER (o_orderkey % 50 = 0)", "orders"),
    _row("odd", "score_null", "p", "count(*) FILTER (o_orderkey % 20 = 3)", "orders"),
    _FIXED.format("ones", "label_single_class", "'y'")]))
def check_scored(spark, folder):
    df = rated(spark, folder).withColumn("late_y", F.expr("CASE WHEN o_orderstatus = 'P' THEN NULL ELSE y END"))
    ones = rated(spark, folder).withColumn("y", F.lit(1))
    odd = rated(spark, folder).withColumn("y", F.expr("CASE WHEN o_orderkey % 50 = 0 THEN 2 ELSE y END")).withColumn(
        "p", F.expr("CASE WHEN o_orderkey % 40 = 3 THEN double('NaN') WHEN o_orderkey % 40 = 23 THEN double('infinity') ELSE p END"))
    return contracts.check_scored(df, "late_y", "p", "orders").unionByName(contracts.check_scored(odd, "y", "p", "odd")).unionByName(contracts.check_scored(ones, "y", "p", "ones"))
