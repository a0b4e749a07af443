"""Fitted preprocessing."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import APPLICANT_SQL, applicant
from catalog.registry import query, r, rnd, rounded, table
from riskloom.operators import preprocess

COLUMNS = ["AMT_INCOME_TOTAL", "EXT_SOURCE_1", "EXT_SOURCE_3", "CNT_FAM_MEMBERS", "OCCUPATION_TYPE", "CODE_GENDER"]
NUMERIC = COLUMNS[:4]
_TRAIN = "md5(SK_ID_CURR::VARCHAR || '|42') < 'b'"  # part of the rows to fit on; all rows are transformed


def _train(df):
    from riskloom.functions.columns import row_hash

    return df.filter(row_hash("SK_ID_CURR", 42) < "b")


def _fitted_sql(train: str = "a") -> str:
    """CTEs: a, f (train rows), med, imp, fen, clip, mom and one value per categorical mode."""
    med = ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in NUMERIC)
    imp = ", ".join(f"coalesce({train}.{c}, med.{c})::DOUBLE AS {c}" for c in NUMERIC)
    fen = ", ".join(f"quantile_cont({c}, 0.25) - 1.5::DOUBLE * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS {c}_lo, "
                    f"quantile_cont({c}, 0.75) + 1.5::DOUBLE * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS {c}_hi"
                    for c in NUMERIC)
    clip = ", ".join(f"greatest(least({c}, {c}_hi), {c}_lo) AS {c}" for c in NUMERIC)
    mom = ", ".join(f"avg({c}) AS {c}_m, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS {c}_s" for c in NUMERIC)
    return f"""a AS ({APPLICANT_SQL}), f AS (SELECT * FROM a WHERE {_TRAIN}), med AS (SELECT {med} FROM {train}),
    imp AS (SELECT {imp} FROM {train}, med), fen AS (SELECT {fen} FROM imp), clip AS (SELECT {clip} FROM imp, fen),
    mom AS (SELECT {mom} FROM clip)"""


@query("impute_median", f"""WITH {_fitted_sql()} SELECT SK_ID_CURR, {', '.join(r(f'coalesce(a.{c}, med.{c})', c) for c in NUMERIC)}
FROM a, med""")
def impute_median(spark, folder):
    df = applicant(spark, folder)
    fill = preprocess.medians(df, NUMERIC)
    return rounded(df.select("SK_ID_CURR", *[F.coalesce(F.col(c).cast("double"), F.lit(fill[c])).alias(c) for c in NUMERIC]))


def _top(c: str, source: str) -> str:
    return f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


@query("impute_mode", f"""WITH a AS ({APPLICANT_SQL}) SELECT SK_ID_CURR, coalesce(OCCUPATION_TYPE, {_top('OCCUPATION_TYPE', 'a')})
AS occupation, coalesce(NAME_INCOME_TYPE, {_top('NAME_INCOME_TYPE', 'a')}) AS income FROM a""")
def impute_mode(spark, folder):
    df = applicant(spark, folder)
    mode = preprocess.category_modes(df, ["OCCUPATION_TYPE", "NAME_INCOME_TYPE"])
    return df.select("SK_ID_CURR", F.coalesce("OCCUPATION_TYPE", F.lit(mode["OCCUPATION_TYPE"])).alias("occupation"),
                     F.coalesce("NAME_INCOME_TYPE", F.lit(mode["NAME_INCOME_TYPE"])).alias("income"))


@query("iqr_clip", """WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders)
SELECT o_orderkey, round(greatest(least(o_totalprice, q3 + 0.4::DOUBLE * (q3 - q1)), q1 - 0.4::DOUBLE * (q3 - q1)), 4)
+ 0.0::DOUBLE AS price FROM orders, q""")
def iqr_clip(spark, folder):
    df = table(spark, folder, "orders")
    fence = preprocess.tukey_fences(df, ["o_totalprice"], 0.4)["o_totalprice"]
    return df.select("o_orderkey", rnd(preprocess.clipped(F.col("o_totalprice"), *fence), 4).alias("price"))


@query("standardise", f"""SELECT p_partkey, {r('''(p_retailprice - (SELECT avg(p_retailprice) FROM part)) /
(SELECT stddev_pop(p_retailprice) FROM part)''', 'price')}, 0.0::DOUBLE AS flat FROM part""")
def standardise(spark, folder):
    df = table(spark, folder, "part").withColumn("flat", F.lit(3.0))
    stats = preprocess.moments(df, {c: F.col(c) for c in ("p_retailprice", "flat")})
    return rounded(df.select("p_partkey", *[((F.col(c) - F.lit(stats[c][0])) / F.lit(stats[c][1])).alias(n)
                                            for c, n in (("p_retailprice", "price"), ("flat", "flat"))]))


@query("one_hot", """SELECT o_orderkey, """ + ", ".join(
    f"(o_orderpriority = '{v}')::INT::DOUBLE AS \"{v}\"" for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))
    + " FROM orders")
def one_hot(spark, folder):
    df = table(spark, folder, "orders")
    model = preprocess.TabularPreprocessor(inputCols=["o_orderpriority"]).fit(df)
    made = model.transform_columns(df, ["o_orderkey"])
    return made.select("o_orderkey", *[F.col(f"`{c}`").alias(c.removeprefix("o_orderpriority_")) for c in made.columns[1:]])


def _transformed(train: str) -> str:
    num = ", ".join(r(f"(greatest(least(coalesce(a.{c}, med.{c}), {c}_hi), {c}_lo) - {c}_m) / {c}_s", c) for c in NUMERIC)
    cat = ", ".join(
        f"(coalesce(a.OCCUPATION_TYPE, {_top('OCCUPATION_TYPE', train)}) = '{v}')::INT::DOUBLE AS \"OCCUPATION_TYPE_{v}\""
        for v in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"))
    sex = ", ".join(f"(CODE_GENDER = '{v}')::INT::DOUBLE AS CODE_GENDER_{v}" for v in ("F", "M", "XNA"))
    return f"WITH {_fitted_sql(train)} SELECT SK_ID_CURR, {num}, {cat}, {sex} FROM a, med, fen, mom"


@query("preprocess_transform", _transformed("a"))
def preprocess_transform(spark, folder):
    df = applicant(spark, folder)
    model = preprocess.TabularPreprocessor(inputCols=COLUMNS).fit(df)
    return rounded(model.transform_columns(model.align(df, ["SK_ID_CURR"]), ["SK_ID_CURR"]))


@query("transform_frozen", _transformed("f"))
def transform_frozen(spark, folder):
    from riskloom.session import shared_folder

    df = applicant(spark, folder)
    path = shared_folder(spark, "preprocessor")
    preprocess.TabularPreprocessor(inputCols=COLUMNS).fit(_train(df)).write().overwrite().save(path)
    model = preprocess.TabularPreprocessorModel.load(path)
    return rounded(model.transform_columns(model.align(df, ["SK_ID_CURR"]), ["SK_ID_CURR"]))


@query("one_hot_wide", """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'common' ELSE 'k' || (o_orderkey // 4) END AS code, o_orderpriority FROM orders),
f AS (SELECT * FROM o WHERE o_orderkey % 5 <> 0),
c AS (SELECT code, row_number() OVER (ORDER BY encode(code)) - 1 AS place FROM (SELECT DISTINCT code FROM f)),
p AS (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 1 AS place FROM (SELECT DISTINCT o_orderpriority FROM f))
SELECT o_orderkey, (SELECT count(*) FROM c) + (SELECT count(*) FROM p) AS size, c.place::BIGINT AS code_at, (p.place + (SELECT count(*) FROM c))::BIGINT AS priority_at
FROM o LEFT JOIN c USING (code) LEFT JOIN p USING (o_orderpriority)""")
def one_hot_wide(spark, folder):
    """A near-unique column, a third of whose rows share one value, fitted on four fifths of the rows: its levels are a
    table, never a list in the driver."""
    code = F.when(F.col("o_orderkey") % 3 == 0, "common").otherwise(F.concat(F.lit("k"), F.floor(F.col("o_orderkey") / 4).cast("string")))
    df = table(spark, folder, "orders").select("o_orderkey", code.alias("code"), "o_orderpriority")
    model = preprocess.TabularPreprocessor(inputCols=["code", "o_orderpriority"], heldLevels=100).fit(df.filter(F.col("o_orderkey") % 5 != 0))
    made = model.transform(df)
    wide = model.getOrDefault(model.wide)["code"][0]
    shown = F.regexp_extract(F.col("features").cast("string"), r"\[([0-9,]*)\]", 1)  # the places of a sparse vector
    at = F.transform(F.filter(F.split(shown, ","), lambda i: i != ""), lambda i: i.cast("long"))
    return made.select("o_orderkey", F.lit(model.output_size()).cast("long").alias("size"), at.alias("at")).select(
        "o_orderkey", "size", F.element_at(F.filter("at", lambda i: i < wide), 1).alias("code_at"),
        F.element_at(F.filter("at", lambda i: i >= wide), 1).alias("priority_at"))
