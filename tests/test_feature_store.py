"""Keyed lookups that read only the buckets of the requested ids, and batch comparison in one exchange."""

import re

import pytest
from pyspark.sql import functions as F

from riskloom.operators.drift import batches_identical, row_count_differences
from riskloom.sources import feature_store
from riskloom.sources.feature_store import FeatureStore


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store"))
    df = spark.range(5000).select(F.concat(F.lit("a"), F.col("id").cast("string")).alias("id"), (F.col("id") * 2.0).alias("x"))
    FeatureStore.write(df, path, "id", rows_per_bucket=100)
    return FeatureStore.open(spark, path), df


def test_lookup_finds_and_names_unknown(spark, store):
    own, df = store
    asked = spark.createDataFrame([("a7", 1), ("zz", 2), ("a4999", 3), (None, 4), ("a7", 5)], "id string, request_pos int")
    found, unknown = own.lookup(asked)
    assert sorted(map(tuple, found.select("id", "request_pos", "x").collect())) == [("a4999", 3, 9998.0), ("a7", 1, 14.0), ("a7", 5, 14.0)]
    assert sorted(r["request_pos"] for r in unknown.collect()) == [2, 4]
    assert own.rows(spark).exceptAll(df).isEmpty() and df.exceptAll(own.rows(spark)).isEmpty()


def test_only_the_buckets_asked_for_are_read(spark, store):
    own, _ = store
    asked = spark.createDataFrame([("a7",), ("a8",)], "id string")
    found, _ = own.lookup(asked)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text
    assert f"{feature_store.BUCKET_COLUMN}" in re.search(r"PartitionFilters: \[[^\]]*", text).group()
    assert "PushedFilters: [In(id" in text
    scan = own.pruned(asked)
    scan.collect()
    leaves = scan._jdf.queryExecution().executedPlan().collectLeaves()
    files = leaves.apply(0).metrics().apply("numFiles").value()
    assert own.buckets == 50 and files <= 2


def test_too_many_requests_are_refused(spark, store, monkeypatch):
    monkeypatch.setattr(feature_store, "MOST_REQUESTS", 3)
    with pytest.raises(ValueError, match="more than 3"):
        store[0].lookup(spark.range(4).select(F.col("id").cast("string").alias("id")))
    assert store[0].pruned(spark.createDataFrame([], "id string")).count() == 0


def test_comparison_counts_rows_in_one_exchange(spark):
    a = spark.createDataFrame([(1, "x", [1, None]), (1, "x", [1, None]), (2, None, None)], "k int, s string, v array<int>")
    b = spark.createDataFrame([(2, None, None), (1, "x", [1, None]), (1, "x", [1, None])], "k int, s string, v array<int>")
    assert batches_identical(a, b)
    assert not batches_identical(a, b.limit(2))
    assert not batches_identical(a, b.withColumn("v", F.when(F.col("v").isNotNull(), F.array(F.lit(None).cast("int"), F.lit(1)))))
    assert batches_identical(a, b.withColumn("k", F.col("k").cast("long")))
    assert not batches_identical(a, b.withColumn("k", F.col("k").cast("long") + 1))
    moved = row_count_differences(a, a.limit(1).unionByName(a))
    assert [r["n"] for r in moved.collect()] == [-1]
    plan = moved._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    c = spark.createDataFrame([({"p": 1, "q": 2},)], "m map<string,int>")
    d = spark.createDataFrame([({"q": 2, "p": 1},)], "m map<string,int>")
    assert batches_identical(c, d) and not batches_identical(c, d.select(F.map_concat("m", F.create_map(F.lit("r"), F.lit(1))).alias("m")))
