"""A feature store on files that a batch of ids can be looked up in without reading or shuffling the store.

Rows are dealt to buckets by the hash of their key; a bucket is a folder and its rows are sorted by key. A batch of
requests, whose size is bounded, tells its buckets, and the scan lists only those folders (static partition pruning);
ids in the scan's filter then skip row groups by their statistics. The store's side of the lookup has no exchange, as
the requests are broadcast: their number is checked.
"""

from __future__ import annotations

import dataclasses
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.columns import named
from riskloom.sources.tables import read_json

BUCKET_COLUMN = "key_bucket"
ROWS_PER_BUCKET = 1_000_000
#: So many requests are looked up at a time; more are refused, a join with the whole store serves them better.
MOST_REQUESTS = 10_000


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


@dataclasses.dataclass(frozen=True)
class FeatureStore:
    path: str
    key: str
    buckets: int

    @classmethod
    def write(cls, df: DataFrame, path: str, key: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> FeatureStore:
        """One shuffle by bucket; a bucket is one task's file, whatever the distribution of the keys."""
        if BUCKET_COLUMN in df.columns:
            raise ValueError(f"column {BUCKET_COLUMN} is the store's own")
        buckets = max(1, math.ceil(df.count() / rows_per_bucket))
        dealt = df.withColumn(BUCKET_COLUMN, _bucket(named(key), buckets))
        dealt.repartition(buckets, BUCKET_COLUMN).sortWithinPartitions(BUCKET_COLUMN, named(key)).write.partitionBy(BUCKET_COLUMN).parquet(f"{path}/rows")
        spark = df.sparkSession
        spark.createDataFrame([(key, buckets)], "key string, buckets int").coalesce(1).write.json(f"{path}/layout")
        return cls(path, key, buckets)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> FeatureStore:
        layout = read_json(spark, f"{path}/layout", "key string, buckets int").first()
        return cls(path, layout["key"], int(layout["buckets"]))

    def rows(self, spark: SparkSession) -> DataFrame:
        """The whole store, without its bucket column."""
        return spark.read.parquet(f"{self.path}/rows").drop(BUCKET_COLUMN)

    def pruned(self, requests: DataFrame) -> DataFrame:
        """The store's rows of the requested ids, read from the folders of their buckets alone."""
        spark, own = requests.sparkSession, named(self.key)
        asked = requests.select(own.alias("id"), _bucket(own, self.buckets).alias("bucket")).limit(MOST_REQUESTS + 1).collect()
        if len(asked) > MOST_REQUESTS:
            raise ValueError(f"more than {MOST_REQUESTS} requests in one lookup")
        known = [r for r in asked if r["id"] is not None]
        stored = spark.read.parquet(f"{self.path}/rows")
        wanted = F.col(BUCKET_COLUMN).isin(sorted({r["bucket"] for r in known})) & own.isin(sorted({r["id"] for r in known}))
        return (stored.filter(wanted) if known else stored.limit(0)).drop(BUCKET_COLUMN)

    def lookup(self, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(requests with their features, requests whose id is unknown), as ``scoring.lookup_features`` gives them."""
        rows = self.pruned(requests)
        found = F.broadcast(requests).join(rows, self.key)  # at most MOST_REQUESTS rows
        return found, requests.join(rows.select(named(self.key)), self.key, "left_anti")
