"""Sources and sinks, projections, cleaning, domain features."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import APPLICANT, APPLICANT_SQL, RATED_SQL, SCORED_SQL, applicant, rated, scored
from catalog.registry import query, r, rnd, rounded, table
from riskloom.functions.columns import finite
from riskloom.operators import alignment, cleaning, features, quality, scores
from riskloom.session import shared_folder
from riskloom.sources import sinks, tables as sources

ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS day,
o_orderpriority FROM orders"""


def _orders(spark, folder):
    return table(spark, folder, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd")).drop("o_orderdate")


@query("scan_parquet", "SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_parquet(spark, folder):
    read = sources.read_parquet_tables(spark, folder, {"customer": "customer.parquet"})
    return rounded(read["customer"])


@query("scan_csv", ORDERS_SQL)
def scan_csv(spark, folder):
    where = shared_folder(spark, "csv")
    sinks.write_csv(_orders(spark, folder), f"{where}/orders")
    schema = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string, "
              "day string")
    return sources.read_csv_tables(spark, where, {"orders": "orders"}, {"orders": schema})["orders"]


@query("sink_parquet", ORDERS_SQL)
def sink_parquet(spark, folder):
    path = sinks.write_parquet(_orders(spark, folder), shared_folder(spark, "parquet"))
    return sources.read_parquet(spark, path)


@query("sink_csv", "SELECT s_suppkey, s_name, s_nationkey::BIGINT AS s_nationkey, s_acctbal FROM supplier")
def sink_csv(spark, folder):
    path = sinks.write_csv(table(spark, folder, "supplier"), shared_folder(spark, "supplier"))
    return spark.read.option("header", True).schema(
        "s_suppkey long, s_name string, s_nationkey long, s_acctbal double").csv(path)


@query("sink_json", f"SELECT n_nationkey::BIGINT AS n_nationkey, n_name, n_regionkey::BIGINT AS n_regionkey FROM nation")
def sink_json(spark, folder):
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name", "n_regionkey")
    path = sinks.write_json(nations, shared_folder(spark, "nation"))
    return sources.read_json(spark, path, "n_nationkey long, n_name string, n_regionkey long")


@query("project_drop", "SELECT c_name, c_acctbal, c_mktsegment FROM customer")
def project_drop(spark, folder):
    return cleaning.drop_quietly(table(spark, folder, "customer"), ["c_custkey", "c_nationkey", "TARGET"])


@query("align_lenient", "SELECT p_brand, NULL::DOUBLE AS p_weight, p_size::BIGINT AS p_size, p_type FROM part")
def align_lenient(spark, folder):
    return rounded(alignment.align_lenient(table(spark, folder, "part"), ["p_brand", "p_weight", "p_size", "p_type"]))


@query("align_strict", "SELECT p_partkey, p_type, p_retailprice FROM part")
def align_strict(spark, folder):
    return alignment.align_strict(table(spark, folder, "part"), ["p_type", "p_retailprice"], keep=["p_partkey"])


@query("narrow_types", """SELECT p_partkey::BIGINT AS p_partkey, p_name, p_brand, p_type, p_size::BIGINT AS p_size,
round(p_retailprice::FLOAT::DOUBLE, 3) + 0.0::DOUBLE AS p_retailprice,
CASE WHEN max(p_partkey) OVER () <= 127 THEN 'tinyint' WHEN max(p_partkey) OVER () <= 32767 THEN 'smallint'
ELSE 'int' END AS key_type, 'tinyint' AS size_type, 'float' AS price_type FROM part""")
def narrow_types(spark, folder):
    df = quality.narrow_types(table(spark, folder, "part"))
    kinds = dict(df.dtypes)
    return rounded(df, 3).withColumn("key_type", F.lit(kinds["p_partkey"])).withColumn(
        "size_type", F.lit(kinds["p_size"])).withColumn("price_type", F.lit(kinds["p_retailprice"]))


_INFORMATIVE = [c for c in APPLICANT if c != "FLAG_MOBIL"]


@query("low_information", f"SELECT SK_ID_CURR, TARGET, AMT_CREDIT, 'FLAG_MOBIL,SK_ID_PREV' AS dropped FROM ({APPLICANT_SQL})")
def low_information(spark, folder):
    df = applicant(spark, folder).select("SK_ID_CURR", "TARGET", "AMT_CREDIT", "FLAG_MOBIL",
                                         F.col("SK_ID_CURR").alias("SK_ID_PREV"))
    kept, dropped = quality.drop_low_information(df)
    return rounded(kept.withColumn("dropped", F.lit(",".join(dropped))))


@query("high_missing", f"""SELECT SK_ID_CURR, EXT_SOURCE_1 IS NULL AS ext_missing, 'OWN_CAR_AGE' AS dropped
FROM ({APPLICANT_SQL})""")
def high_missing(spark, folder):
    df = applicant(spark, folder).select("SK_ID_CURR", "EXT_SOURCE_1", "OWN_CAR_AGE", "EXT_SOURCE_3")
    dropped = quality.high_missing_columns(df)
    return df.drop(*dropped).select("SK_ID_CURR", F.col("EXT_SOURCE_1").isNull().alias("ext_missing"),
                                    F.lit(",".join(dropped)).alias("dropped"))


@query("sentinel_flag", f"""SELECT SK_ID_CURR, CASE WHEN DAYS_EMPLOYED = 365243 THEN NULL ELSE DAYS_EMPLOYED END AS days,
CASE WHEN DAYS_EMPLOYED = 365243 THEN 1 ELSE 0 END::BIGINT AS flag FROM ({APPLICANT_SQL})""")
def sentinel_flag(spark, folder):
    c = F.col("DAYS_EMPLOYED")
    return rounded(applicant(spark, folder).select(
        "SK_ID_CURR", cleaning.without_sentinel(c, 365243).alias("days"), cleaning.sentinel_flag(c, 365243).alias("flag")))


@query("sign_flip", f"SELECT SK_ID_CURR, abs(DAYS_BIRTH) AS birth, abs(DAYS_ID_PUBLISH) AS published FROM ({APPLICANT_SQL})")
def sign_flip(spark, folder):
    return applicant(spark, folder).select("SK_ID_CURR", cleaning.positive_days(F.col("DAYS_BIRTH")).alias("birth"),
                                           cleaning.positive_days(F.col("DAYS_ID_PUBLISH")).alias("published"))


_MODE = "(SELECT {c} FROM a WHERE {c} IS NOT NULL AND {c} <> 'XNA' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


@query("mode_replace", f"""WITH a AS ({APPLICANT_SQL}) SELECT SK_ID_CURR, CASE WHEN CODE_GENDER = 'XNA' THEN
{_MODE.format(c='CODE_GENDER')} ELSE CODE_GENDER END AS gender FROM a""")
def mode_replace(spark, folder):
    df, c = applicant(spark, folder), F.col("CODE_GENDER")
    top = cleaning.modes(df, {"mode": F.when(c != "XNA", c)})["mode"]
    return df.select("SK_ID_CURR", cleaning.replaced_code(c, "XNA", top).alias("gender"))


@query("conditional_fill", f"""SELECT SK_ID_CURR, CASE WHEN OCCUPATION_TYPE IS NOT NULL THEN OCCUPATION_TYPE
WHEN DAYS_EMPLOYED = 365243 THEN 'Not_Employed' ELSE 'Unknown' END AS occupation FROM ({APPLICANT_SQL})""")
def conditional_fill(spark, folder):
    flag = cleaning.sentinel_flag(F.col("DAYS_EMPLOYED"), 365243)
    return applicant(spark, folder).select("SK_ID_CURR", cleaning.filled_by_flag(
        F.col("OCCUPATION_TYPE"), flag, "Not_Employed", "Unknown").alias("occupation"))


@query("quantile_cap", f"""SELECT o_orderkey, {r('least(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.999) FROM orders))',
'capped', 4)} FROM orders""")
def quantile_cap(spark, folder):
    df = table(spark, folder, "orders")
    cap = cleaning.quantiles(df, {"o_totalprice": [0.999]})["o_totalprice"][0]
    return df.select("o_orderkey", rnd(cleaning.capped(F.col("o_totalprice"), cap), 4).alias("capped"))


@query("hard_cap", f"SELECT SK_ID_CURR, least(CNT_CHILDREN, 10) AS children FROM ({APPLICANT_SQL})")
def hard_cap(spark, folder):
    return applicant(spark, folder).select("SK_ID_CURR", cleaning.capped(F.col("CNT_CHILDREN"), 10).alias("children"))


@query("clean_chain", f"""WITH a AS ({APPLICANT_SQL}) SELECT SK_ID_CURR, TARGET::BIGINT AS TARGET,
{r('least(AMT_INCOME_TOTAL, (SELECT quantile_cont(AMT_INCOME_TOTAL, 0.999) FROM a))', 'AMT_INCOME_TOTAL', 4)},
{r('AMT_CREDIT', 'AMT_CREDIT', 4)}, {r('AMT_ANNUITY', 'AMT_ANNUITY', 4)}, {r('AMT_GOODS_PRICE', 'AMT_GOODS_PRICE', 4)},
CNT_FAM_MEMBERS, least(CNT_CHILDREN, 10) AS CNT_CHILDREN, abs(DAYS_BIRTH) AS DAYS_BIRTH,
CASE WHEN DAYS_EMPLOYED = 365243 THEN NULL ELSE abs(DAYS_EMPLOYED) END AS DAYS_EMPLOYED,
abs(DAYS_REGISTRATION) AS DAYS_REGISTRATION, abs(DAYS_ID_PUBLISH) AS DAYS_ID_PUBLISH,
CASE WHEN CODE_GENDER = 'XNA' THEN {_MODE.format(c='CODE_GENDER')} ELSE CODE_GENDER END AS CODE_GENDER,
CASE WHEN OCCUPATION_TYPE IS NOT NULL THEN OCCUPATION_TYPE WHEN DAYS_EMPLOYED = 365243 THEN 'Not_Employed'
ELSE 'Unknown' END AS OCCUPATION_TYPE, NAME_INCOME_TYPE, {r('EXT_SOURCE_1', 'EXT_SOURCE_1', 4)},
{r('EXT_SOURCE_2', 'EXT_SOURCE_2', 4)}, {r('EXT_SOURCE_3', 'EXT_SOURCE_3', 4)}, FLAG_MOBIL::BIGINT AS FLAG_MOBIL,
CASE WHEN DAYS_EMPLOYED = 365243 THEN 1 ELSE 0 END::BIGINT AS DAYS_EMPLOYED_ANOM FROM a""")
def clean_chain(spark, folder):
    return rounded(cleaning.clean_applications(applicant(spark, folder)), 4)


_MESSY = "CASE WHEN l_linenumber = 1 THEN 'n/a' WHEN l_linenumber = 2 THEN 'NaN' WHEN l_linenumber = 3 THEN 'Infinity' " \
         "ELSE CAST(l_linenumber * 10 AS {text}) END"


@query("finite_only", f"""WITH t AS (SELECT l_orderkey, TRY_CAST({_MESSY.format(text='VARCHAR')} AS DOUBLE) AS x FROM lineitem)
SELECT l_orderkey, CASE WHEN isfinite(x) THEN x END AS x FROM t""")
def finite_only(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", finite(F.expr(_MESSY.format(text="STRING"))).alias("x"))


@query("threshold_class", f"SELECT o_orderkey, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END::BIGINT AS cls FROM ({RATED_SQL})")
def threshold_class(spark, folder):
    return rounded(rated(spark, folder).select("o_orderkey", scores.threshold_class(F.col("p"), 0.5).alias("cls")))


@query("minmax_scores", f"""SELECT o_orderkey, {r('''(o_totalprice - (SELECT min(o_totalprice) FROM orders)) /
((SELECT max(o_totalprice) - min(o_totalprice) FROM orders) + 1e-12)''', 'score')} FROM orders""")
def minmax_scores(spark, folder):
    return scores.minmax_scores(table(spark, folder, "orders"), "o_totalprice", "score").select("o_orderkey", rnd("score").alias("score"))


_RATIO = {
    "DEBT_BURDEN_RATIO": "AMT_ANNUITY / (AMT_INCOME_TOTAL + 1e-6)",
    "CREDIT_INCOME_RATIO": "AMT_CREDIT / (AMT_INCOME_TOTAL + 1e-6)",
    "ANNUITY_CREDIT_RATIO": "AMT_ANNUITY / (AMT_CREDIT + 1e-6)",
    "PAYMENT_RATE": "AMT_ANNUITY / (AMT_CREDIT + 1e-6)",
    "GOODS_CREDIT_RATIO": "AMT_GOODS_PRICE / (AMT_CREDIT + 1e-6)",
    "CREDIT_GOODS_DIFF": "AMT_CREDIT - AMT_GOODS_PRICE",
}
_EMPLOYED = "CASE WHEN DAYS_EMPLOYED = 365243 THEN NULL ELSE DAYS_EMPLOYED END"
_TENURE = {
    "AGE_YEARS": "-DAYS_BIRTH / 365.25::DOUBLE",
    "DAYS_EMPLOYED_CLEAN": _EMPLOYED,
    "YEARS_EMPLOYED": f"-({_EMPLOYED}) / 365.25::DOUBLE",
    "EMPLOYMENT_LIFE_FRACTION": f"-({_EMPLOYED}) / (-DAYS_BIRTH + 1e-6)",
    "YEARS_SINCE_REGISTRATION": "-DAYS_REGISTRATION / 365.25::DOUBLE",
    "YEARS_SINCE_ID_CHANGE": "-DAYS_ID_PUBLISH / 365.25::DOUBLE",
}
_EXT = "[EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3]"
_ROW = {
    "EXT_SOURCE_MEAN": f"list_avg({_EXT})",
    "EXT_SOURCE_SUM": f"coalesce(list_sum({_EXT}), 0)",
    "EXT_SOURCE_MIN": "least(EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3)",
    "EXT_SOURCE_MAX": "greatest(EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3)",
    "EXT_SOURCE_STD": f"list_stddev_samp({_EXT})",
    "EXT_SOURCE_RANGE": "greatest(EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3) - least(EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3)",
}
_WEIGHTED = {"EXT_SOURCE_WEIGHTED": "EXT_SOURCE_1 * 0.25::DOUBLE + EXT_SOURCE_2 * 0.5::DOUBLE + EXT_SOURCE_3 * 0.25::DOUBLE"}
_PERSON = {
    "INCOME_PER_PERSON": "AMT_INCOME_TOTAL / (CNT_FAM_MEMBERS + 1e-6)",
    "CREDIT_PER_PERSON": "AMT_CREDIT / (CNT_FAM_MEMBERS + 1e-6)",
}


def _made(groups: dict, integers: tuple = ("DAYS_EMPLOYED_CLEAN",)) -> str:
    cells = [f"({e}) AS {c}" if c in integers else r(e, c) for c, e in groups.items()]
    return f"SELECT SK_ID_CURR, {', '.join(cells)} FROM ({APPLICANT_SQL})"


def _features(names):
    def run(spark, folder):
        return rounded(features.add_domain_features(applicant(spark, folder)).select("SK_ID_CURR", *names))
    return run


for _name, _group in {
    "ratio_features": _RATIO, "tenure_features": _TENURE, "row_stats": _ROW, "weighted_score": _WEIGHTED,
    "per_person": _PERSON, "domain_features": {**_RATIO, **_TENURE, **_ROW, **_WEIGHTED, **_PERSON},
}.items():
    query(_name, _made(_group))(_features(list(_group)))
