"""Readers: named sets of CSV tables, Parquet tables and JSON records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskloom.functions.columns import nan_to_null

# Logical table name -> file name of the public credit-default tables.
CREDIT_FILES = {
    "application_train": "application_train.csv",
    "application_test": "application_test.csv",
    "bureau": "bureau.csv",
    "bureau_balance": "bureau_balance.csv",
    "previous_application": "previous_application.csv",
    "pos_cash": "POS_CASH_balance.csv",
    "credit_card": "credit_card_balance.csv",
    "installments": "installments_payments.csv",
}


class MissingTables(FileNotFoundError):
    """Names every absent path at once."""


def check_paths(spark: SparkSession, paths: Mapping[str, str]) -> None:
    """Ask the file system behind each path, so object stores work as well as local disks."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    absent = []
    for path in paths.values():
        handle = jvm.org.apache.hadoop.fs.Path(path)
        matches = handle.getFileSystem(conf).globStatus(handle)
        if matches is None or len(matches) == 0:
            absent.append(path)
    if absent:
        raise MissingTables(f"{len(absent)} required path(s) not found: " + ", ".join(sorted(absent)))


def read_csv_tables(spark: SparkSession, folder: str, files: Mapping[str, str] | None = None,
                    schemas: Mapping[str, T.StructType | str] | None = None) -> dict[str, DataFrame]:
    """Lazy scans of a named set of headed CSV tables.

    Pass ``schemas`` for large inputs: without one Spark must read a table once more to infer it.
    """
    files = dict(files or CREDIT_FILES)
    paths = {name: f"{folder.rstrip('/')}/{file}" for name, file in files.items()}
    check_paths(spark, paths)
    tables = {}
    for name, path in paths.items():
        reader = spark.read.option("header", True)
        schema = (schemas or {}).get(name)
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
        tables[name] = nan_to_null(reader.csv(path))
    return tables


def read_parquet(spark: SparkSession, path: str, nan_as_null: bool = False) -> DataFrame:
    """Columns come as stored, so that filters on doubles reach the files; the operators treat NaN as missing.
    ``nan_as_null`` replaces it on reading, for work that does not go through them."""
    df = spark.read.parquet(path)
    return nan_to_null(df) if nan_as_null else df


def read_parquet_tables(spark: SparkSession, folder: str, files: Mapping[str, str]) -> dict[str, DataFrame]:
    paths = {name: f"{folder.rstrip('/')}/{file}" for name, file in files.items()}
    check_paths(spark, paths)
    return {name: read_parquet(spark, path, nan_as_null=True) for name, path in paths.items()}


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
              whole_files: bool = False) -> DataFrame:
    """One record per line, which Spark can split; ``whole_files`` for one pretty-printed document per file."""
    reader = spark.read.option("multiLine", whole_files)
    return (reader.schema(schema) if schema is not None else reader).json(path)
