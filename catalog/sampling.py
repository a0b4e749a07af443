"""Splits, folds, samples and drift injection."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import APPLICANT_SQL, RATED_SQL, applicant, rated
from catalog.registry import query, r, rounded, table
from riskloom.operators import sampling


def u_sql(key: str, seed: str) -> str:
    return f"('0x' || substr(md5({key}::VARCHAR || '|{seed}'), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE"


@query("split_hash", f"""SELECT o_orderkey, CASE WHEN {u_sql('o_orderkey', '42')} < 0.15::DOUBLE THEN 'test'
WHEN {u_sql('o_orderkey', '42')} < 0.3::DOUBLE THEN 'validation' ELSE 'train' END AS split FROM orders""")
def split_hash(spark, folder):
    return sampling.split_by_hash(table(spark, folder, "orders"), "o_orderkey").select("o_orderkey", "split")


_RANK = "row_number() OVER (PARTITION BY {s} ORDER BY md5({k}::VARCHAR || '|{seed}'), {k})"


@query("split_exact", f"""WITH t AS (SELECT o_orderkey, y, {_RANK.format(s='y', k='o_orderkey', seed=42)} AS i,
count(*) OVER (PARTITION BY y) AS n FROM ({RATED_SQL})) SELECT o_orderkey, y::BIGINT AS y,
CASE WHEN i <= floor(n * 0.15::DOUBLE + 0.5) THEN 'test'
WHEN i <= floor(n * 0.15::DOUBLE + 0.5) * 2 THEN 'validation' ELSE 'train' END AS split FROM t""")
def split_exact(spark, folder):
    return rounded(sampling.split_exact(rated(spark, folder), "o_orderkey", "y").select("o_orderkey", "y", "split"))


@query("kfold", f"""SELECT o_orderkey, ntile(5) OVER (PARTITION BY y ORDER BY md5(o_orderkey::VARCHAR || '|42'), o_orderkey) - 1 AS fold
FROM ({RATED_SQL})""")
def kfold(spark, folder):
    return rounded(sampling.stratified_folds(rated(spark, folder), "o_orderkey", "y", 5).select("o_orderkey", "fold"))


@query("sample_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(o_orderkey::VARCHAR || '|7'), o_orderkey LIMIT 1000")
def sample_n(spark, folder):
    return sampling.sample_rows(table(spark, folder, "orders"), "o_orderkey", 1000, 7).select("o_orderkey", "o_totalprice")


_COLUMNS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, "
            "l_linestatus, l_shipdate")


@query("sample_repeated_keys", f"""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
ORDER BY md5(l_orderkey::VARCHAR || '|7'), l_orderkey, {_COLUMNS} LIMIT 1001""")
def sample_repeated_keys(spark, folder):
    return sampling.sample_rows(table(spark, folder, "lineitem").select(*_COLUMNS.split(", ")), "l_orderkey", 1001, 7).select(
        "l_orderkey", "l_linenumber", "l_partkey")


@query("split_many_strata", f"""WITH t AS (SELECT o_orderkey, o_custkey, {_RANK.format(s='o_custkey', k='o_orderkey', seed=42)} AS i,
count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) SELECT o_orderkey,
CASE WHEN i <= floor(n * 0.15::DOUBLE + 0.5) THEN 'test'
WHEN i <= floor(n * 0.15::DOUBLE + 0.5) * 2 THEN 'validation' ELSE 'train' END AS split FROM t""")
def split_many_strata(spark, folder):
    return sampling.split_exact(table(spark, folder, "orders"), "o_orderkey", "o_custkey").select("o_orderkey", "split")


@query("inject_drift", f"""WITH a AS ({APPLICANT_SQL}), m AS (SELECT NAME_INCOME_TYPE AS top FROM a GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT SK_ID_CURR, {r('AMT_INCOME_TOTAL * 1.18::DOUBLE', 'AMT_INCOME_TOTAL', 4)},
{r('DAYS_BIRTH - 0.25::DOUBLE * (SELECT stddev_pop(DAYS_BIRTH) FROM a)', 'DAYS_BIRTH', 4)},
CASE WHEN {u_sql('SK_ID_CURR', '2026|category')} < 0.15::DOUBLE THEN top ELSE NAME_INCOME_TYPE END AS NAME_INCOME_TYPE,
CASE WHEN {u_sql('SK_ID_CURR', '2026|blank')} >= 0.12::DOUBLE THEN {r('EXT_SOURCE_1', digits=4)} END AS EXT_SOURCE_1,
'AMT_INCOME_TOTAL,DAYS_BIRTH,NAME_INCOME_TYPE,EXT_SOURCE_1 (missing rate)' AS applied FROM a, m""")
def inject_drift(spark, folder):
    df = applicant(spark, folder).select("SK_ID_CURR", "AMT_INCOME_TOTAL", "DAYS_BIRTH", "NAME_INCOME_TYPE", "EXT_SOURCE_1")
    moved, applied = sampling.inject_drift(df, "SK_ID_CURR")
    return rounded(moved.withColumn("applied", F.lit(",".join(applied))), 4)
