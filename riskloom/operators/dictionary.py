"""The levels of wide categorical columns as a table: ranked without a global sort, joined by value at transform.

Only level counts and modes reach the driver. ``(name, value, n, place)``: ``place`` is the 0-based rank of ``value``
among the column's levels in binary order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import category_cells, flat_map
from riskloom.session import shared_folder

#: A value is heavy if it holds more than one in HEAVY rows of its column; there are fewer than HEAVY such values.
HEAVY = 1000


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return flat_map(df, category_cells(columns, "name")).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))


def level_summary(counts: DataFrame) -> DataFrame:
    """One row per column: its number of ``levels``, its ``mode`` (smallest among ties) and its non-null ``rows``."""
    best = F.min_by("value", F.struct(-F.col("n"), F.col("value")))
    return counts.groupBy("name").agg(F.count(F.lit(1)).alias("levels"), best.alias("mode"), F.sum("n").alias("rows"))


def build_dictionary(counts: DataFrame, path: str | None = None) -> str:
    """Rank the levels of every column and write them; returns the path.

    Levels are dealt to ranges of (name, value) and written with the number of their range, so that later steps agree
    on it; ranks run inside a range and start from the number of levels in the ranges before it.
    """
    spark = counts.sparkSession
    dealt = shared_folder(spark, "levels")
    ranged = counts.repartitionByRange(F.col("name"), F.col("value")).withColumn("part", F.spark_partition_id())
    ranged.write.parquet(dealt)
    ranged = spark.read.schema(ranged.schema).parquet(dealt)
    earlier = Window.partitionBy("name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("name", "part").agg(F.count(F.lit(1)).alias("size")).select(  # one row per column and range
        "name", "part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("name", "part").orderBy("value"))
    placed = ranged.withColumn("within", within).join(starts, ["name", "part"])
    path = path or shared_folder(spark, "dictionary")
    placed.select("name", "value", "n", (F.col("start") + F.col("within") - 1).cast("int").alias("place")).write.partitionBy("name").parquet(path)
    return path


def read_dictionary(spark, path: str) -> DataFrame:
    return spark.read.schema("value string, n long, place int, name string").parquet(path)


def with_places(df: DataFrame, values: dict[str, tuple[str, Column]], dictionary: DataFrame, rows: dict[str, int]) -> DataFrame:
    """Add ``<new column>``: the place of the value in the dictionary column of that name, NULL if it is unknown.

    ``values`` maps new column names to (dictionary name, value expression). Heavy values, fewer than HEAVY, are found
    by a broadcast map; the others by a join on the value, in which no value has more than one in HEAVY rows of those
    the dictionary was built from.
    """
    kept = df.columns
    for new, (name, value) in values.items():
        levels = dictionary.filter(F.col("name") == name)
        heavy = F.col("n") > max(1, rows[name] // HEAVY)
        hot = levels.filter(heavy).select(F.col("value").alias("hot_value"), F.col("place").alias("hot_place"))
        cold = levels.filter(~heavy).select(F.col("value").alias("cold_value"), F.col("place").alias("cold_place"))
        cells = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), value.alias("sought"))
        known = cells.join(F.broadcast(hot), F.col("sought") == F.col("hot_value"), "left")
        # rows settled by a heavy value, and missing ones, get keys of their own that meet nothing and spread
        key = F.when(F.col("hot_place").isNotNull() | F.col("sought").isNull(),
                     F.concat(F.lit("\x00\x00"), F.monotonically_increasing_id().cast("string"))).otherwise(F.col("sought"))
        met = known.withColumn("key", F.struct(F.col("hot_place").isNotNull() | F.col("sought").isNull(), key))
        cold = cold.withColumn("cold_key", F.struct(F.lit(False), F.col("cold_value")))
        joined = met.join(cold, F.col("key") == F.col("cold_key"), "left")
        df = joined.select("row.*", F.coalesce("hot_place", "cold_place").alias(new))
        kept = df.columns
    return df
