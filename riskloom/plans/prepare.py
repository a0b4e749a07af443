"""Raw tables to feature tables: validate, roll up once, join both applicant tables, add ratios."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators.contracts import validate_training_tables
from riskloom.operators.features import add_domain_features
from riskloom.operators.quality import drop_low_information, narrow_types
from riskloom.operators.rollup import child_rollups, feature_table
from riskloom.sources.sinks import write_parquet
from riskloom.sources.tables import read_csv_tables

KEY = "SK_ID_CURR"


def validate_job(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row and column counts when every contract holds; one error with all problems otherwise."""
    return validate_training_tables(tables)


def prepare_job(tables: Mapping[str, DataFrame], folder: str, spark: SparkSession, narrow: bool = False) -> dict:
    """Write ``train_features`` and ``test_features`` below ``folder``.

    The child rollups are already partitioned by the applicant key, so they are joined to one table without another
    shuffle. It is written once and read back by both feature tables: the large child tables are scanned once, each
    feature table needs one join, and a lost executor costs no second aggregation.
    """
    used = {n: narrow_types(df) for n, df in tables.items()} if narrow else dict(tables)
    children = reduce(lambda a, b: a.join(b, KEY, "full"), child_rollups(used, KEY))
    rollups = [spark.read.parquet(write_parquet(children, f"{folder}/rollups"))]
    train = add_domain_features(feature_table(used, "application_train", rollups=rollups))
    staged = spark.read.parquet(write_parquet(train, f"{folder}/all_features"))
    kept, dropped = drop_low_information(staged)
    paths = {"train": write_parquet(kept, f"{folder}/train_features"), "dropped_columns": dropped}
    if "application_test" in used:
        test = add_domain_features(feature_table(used, "application_test", rollups=rollups))
        paths["test"] = write_parquet(test, f"{folder}/test_features")
    return paths


def prepare_from_csv(spark: SparkSession, data_folder: str, folder: str, schemas: Mapping | None = None) -> dict:
    tables = read_csv_tables(spark, data_folder, schemas=schemas)
    validate_job(tables)
    return prepare_job(tables, folder, spark)
