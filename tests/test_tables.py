"""Sources, sinks, contracts, cleaning, rollups, features, alignment."""

import math

import pytest
from pyspark.sql import functions as F

from riskloom.operators import alignment, cleaning, contracts, features, quality, rollup
from riskloom.operators.contracts import CREDIT_TABLES, ContractViolation
from riskloom.session import shared_folder
from riskloom.sources import sinks, tables


@pytest.fixture()
def credit(spark):
    child = "SK_ID_CURR long, SK_ID_PREV long, X double"
    return {
        "application_train": spark.createDataFrame(
            [(1, 0, 100.0, 200.0, 10.0), (2, 1, 110.0, 210.0, 11.0), (3, 0, 120.0, 220.0, 12.0)],
            "SK_ID_CURR long, TARGET int, AMT_INCOME_TOTAL double, AMT_CREDIT double, AMT_ANNUITY double"),
        "application_test": spark.createDataFrame(
            [(8, 100.0, 200.0, 10.0), (9, 1.0, 2.0, 1.0)],
            "SK_ID_CURR long, AMT_INCOME_TOTAL double, AMT_CREDIT double, AMT_ANNUITY double"),
        "bureau": spark.createDataFrame([(1, 10, 5.0), (1, 11, 7.0), (8, 12, None)],
                                        "SK_ID_CURR long, SK_ID_BUREAU long, AMT double"),
        "bureau_balance": spark.createDataFrame([(10, -1), (10, -2), (12, -3)], "SK_ID_BUREAU long, MONTHS_BALANCE int"),
        **{n: spark.createDataFrame([(1, 20, 1.0), (9, 21, None)], child)
           for n in ("previous_application", "pos_cash", "credit_card", "installments")},
    }


def test_csv_tables_round_trip_and_missing_paths_are_listed_together(spark):
    folder = shared_folder(spark, "csv")
    sinks.write_csv(spark.createDataFrame([(1, 2.5, None)], "a long, b double, c string"), f"{folder}/one.csv")
    read = tables.read_csv_tables(spark, folder, {"one": "one.csv"}, {"one": "a long, b double, c string"})
    assert read["one"].collect()[0] == (1, 2.5, None)
    with pytest.raises(tables.MissingTables) as error:
        tables.read_csv_tables(spark, folder, {"one": "one.csv", "x": "x.csv", "y": "y.csv"})
    assert "x.csv" in str(error.value) and "y.csv" in str(error.value)


def test_json_keeps_null_fields(spark):
    path = sinks.write_json(spark.createDataFrame([(1, None)], "a long, b string"), shared_folder(spark, "json"))
    assert tables.read_json(spark, path).columns == ["a", "b"]


def test_valid_tables_pass_and_report_shape(credit):
    shape = {r["table_name"]: (r["n_rows"], r["n_columns"]) for r in contracts.validate_training_tables(credit).collect()}
    assert shape["application_train"] == (3, 5)
    assert contracts.validate_inference_tables(credit).count() == 7


def test_all_problems_come_in_one_error(spark, credit):
    broken = dict(credit)
    broken["application_train"] = credit["application_train"].unionAll(
        spark.createDataFrame([(1, None, 1.0, 1.0, 1.0)], credit["application_train"].schema))
    broken["bureau"] = spark.createDataFrame([(None, 1)], "SK_ID_CURR long, SK_ID_BUREAU long")
    broken["pos_cash"] = credit["pos_cash"].filter("false")
    broken["credit_card"] = credit["credit_card"].drop("SK_ID_PREV")
    del broken["installments"]
    with pytest.raises(ContractViolation) as error:
        contracts.validate_training_tables(broken)
    text = str(error.value)
    for part in ("application_train: key_duplicate", "application_train: label_null", "bureau: key_null SK_ID_CURR",
                 "pos_cash: empty", "credit_card: column_missing SK_ID_PREV", "installments: table_missing"):
        assert part in text


def test_application_test_is_optional_for_training_and_needed_for_inference(credit):
    without = {k: v for k, v in credit.items() if k != "application_test"}
    contracts.validate_training_tables(without)
    with pytest.raises(ContractViolation, match="application_test: table_missing"):
        contracts.validate_inference_tables(without)
    assert "application_train" not in contracts.inference_contracts(CREDIT_TABLES)


@pytest.mark.parametrize("values, check", [([0, 1, 2], "label_domain"), ([1, 1], "label_single_class"), ([0, None, 1], "label_null")])
def test_label_checks(spark, values, check):
    df = spark.createDataFrame([(v,) for v in values], "y int")
    assert [r["check"] for r in contracts.check_label(df, "t", "y").collect()] == [check]


def test_frame_guard(spark):
    with pytest.raises(ContractViolation, match="b"):
        contracts.require_frame(spark.createDataFrame([(1,)], "a int"), "t", ["a", "b"])
    with pytest.raises(ContractViolation, match="no rows"):
        contracts.require_frame(spark.createDataFrame([], "a int"), "t", ["a"])


def test_cleaning_chain(spark):
    rows = [(i, -1000 - i, 365243 if i % 5 == 0 else -50 - i, "XNA" if i == 3 else ("M" if i % 3 else "F"),
             None if i % 2 else "Core", float(i) if i < 99 else 1e8, i % 20, None if i % 4 else 0.3, 7 if i == 0 else None)
            for i in range(100)]
    df = spark.createDataFrame(rows, "SK_ID_CURR int, DAYS_BIRTH int, DAYS_EMPLOYED int, CODE_GENDER string, OCCUPATION_TYPE string, "
                                     "AMT_INCOME_TOTAL double, CNT_CHILDREN int, EXT_SOURCE_1 double, OWN_CAR_AGE int")
    out = cleaning.clean_applications(df)
    got = {r["SK_ID_CURR"]: r for r in out.collect()}
    assert "OWN_CAR_AGE" not in out.columns and "EXT_SOURCE_1" in out.columns
    assert got[5]["DAYS_EMPLOYED"] is None and got[5]["DAYS_EMPLOYED_ANOM"] == 1 and got[1]["DAYS_EMPLOYED"] == 51
    assert got[1]["DAYS_BIRTH"] == 1001 and got[3]["CODE_GENDER"] == "M"
    assert got[5]["OCCUPATION_TYPE"] == "Not_Employed" and got[1]["OCCUPATION_TYPE"] == "Unknown"
    assert got[99]["AMT_INCOME_TOTAL"] < 1e8 and got[19]["CNT_CHILDREN"] == 10
    assert "OWN_CAR_AGE" in cleaning.clean_applications(df, drop_high_missing=False).columns


def test_cap_keeps_missing_values(spark):
    df = spark.createDataFrame([(None,), (50,)], "c int").select(cleaning.capped(F.col("c"), 10).alias("c"))
    assert [r["c"] for r in df.collect()] == [None, 10]


def test_rollup_semantics(spark):
    df = spark.createDataFrame([(1, None, 2.0, "a"), (1, 3, 4.0, "b"), (2, None, None, "c"), (None, 9, 9.0, "d")],
                               "k int, a int, b double, s string")
    out = {r["k"]: r for r in rollup.rollup(df, "k", "t").collect()}
    assert set(out) == {1, 2}
    assert out[1]["t_a_count"] == 1 and out[1]["t_b_mean"] == 3.0 and out[2]["t_b_sum"] == 0.0 and out[2]["t_b_mean"] is None
    assert "t_b_count" not in rollup.rollup(df, "k", "t").columns
    assert sorted(r["k"] for r in rollup.rollup(df.select("k", "s"), "k", "t").collect()) == [1, 2]


def test_feature_table_has_the_same_features_for_train_and_test(credit):
    train, test = (rollup.feature_table(credit, t) for t in ("application_train", "application_test"))
    assert set(train.columns) - set(test.columns) == {"TARGET"} and set(test.columns) <= set(train.columns)
    assert train.count() == 3 and test.count() == 2
    assert "bureau_bb_MONTHS_BALANCE_sum_mean" in train.columns
    assert train.filter("SK_ID_CURR = 1").first()["bureau_bb_MONTHS_BALANCE_sum_mean"] == -3.0
    with pytest.raises(ValueError, match="nothing"):
        rollup.feature_table(credit, "nothing")


def test_rollups_shuffle_each_child_once(credit):
    plan = rollup.feature_table(credit)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_domain_features_follow_the_columns_present(spark):
    df = spark.createDataFrame([(10.0, 0.0, None, 0.4, 365243), (5.0, 20.0, 0.1, None, -730)],
                               "AMT_ANNUITY double, AMT_CREDIT double, EXT_SOURCE_1 double, EXT_SOURCE_2 double, DAYS_EMPLOYED int")
    out = features.add_domain_features(df)
    assert "DEBT_BURDEN_RATIO" not in out.columns and "AGE_YEARS" not in out.columns
    a, b = out.collect()
    assert a["PAYMENT_RATE"] == a["ANNUITY_CREDIT_RATIO"] == pytest.approx(1e7)
    assert a["EXT_SOURCE_MEAN"] == 0.4 and a["EXT_SOURCE_STD"] is None and a["EXT_SOURCE_WEIGHTED"] is None
    assert a["DAYS_EMPLOYED_CLEAN"] is None and b["YEARS_EMPLOYED"] == pytest.approx(730 / 365.25)
    both = spark.createDataFrame([(0.2, 0.6)], "EXT_SOURCE_1 double, EXT_SOURCE_3 double")
    row = features.add_domain_features(both).first()
    assert row["EXT_SOURCE_WEIGHTED"] == pytest.approx(0.4)
    assert row["EXT_SOURCE_STD"] == pytest.approx(math.sqrt(0.08)) and row["EXT_SOURCE_RANGE"] == pytest.approx(0.4)


def test_low_information_and_types(spark):
    df = spark.createDataFrame([(1, 5, 1, None, 300, 1.5), (2, 6, 1, None, -1, 2.5)],
                               "SK_ID_CURR long, SK_ID_PREV long, same int, void string, mid int, d double")
    kept, dropped = quality.drop_low_information(df)
    assert dropped == ["SK_ID_PREV", "same", "void"] and kept.columns == ["SK_ID_CURR", "mid", "d"]
    assert dict(quality.narrow_types(df).dtypes) == {"SK_ID_CURR": "tinyint", "SK_ID_PREV": "tinyint", "same": "tinyint",
                                                     "void": "string", "mid": "smallint", "d": "float"}


def test_duplicate_rows_with_and_without_fingerprints(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (1, None), (2, 2), (1, None)], "a int, b int")
    assert quality.duplicate_rows(df).first()["n"] == 2
    profile = quality.missing_profile(df).collect()
    assert [(r["column_name"], r["missing_count"]) for r in profile] == [("b", 3), ("a", 1)]


def test_alignment(spark):
    df = spark.createDataFrame([(1, "x", 9)], "a int, b string, extra int")
    lenient = alignment.align_lenient(df, ["b", "new", "a"])
    assert lenient.columns == ["b", "new", "a"] and lenient.first()["new"] is None
    assert alignment.align_strict(df, ["b"], keep=["a"]).columns == ["a", "b"]
    with pytest.raises(alignment.SchemaMismatch, match="12 column"):
        alignment.align_strict(df, [f"c{i}" for i in range(12)])
    with pytest.raises(alignment.SchemaMismatch, match="no rows"):
        alignment.align_strict(df.filter("false"), ["a"])


def test_filters_on_doubles_reach_the_files(spark, tiny):
    from riskloom.sources.tables import read_parquet

    plan = read_parquet(spark, f"{tiny}/customer.parquet").filter("c_acctbal < 0")._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(c_acctbal,0.0)" in plan
