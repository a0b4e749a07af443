"""Session construction for local runs, and the folder that every executor can reach."""

from __future__ import annotations

import pathlib
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("riskloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no stack capture per column call
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below ``spark.checkpoint.dir`` for tables that must outlive an executor.

    The cluster names that folder. Only a local session, which has nothing but its own disk, may go
    without one and then gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        application = spark.sparkContext.applicationId
        if application not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="riskloom-")
        root = _LOCAL_FOLDERS[application]
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship_library(spark: SparkSession) -> None:
    """Give the executors this package, once per application, for sessions started without it on their path."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = pathlib.Path(__file__).resolve().parent
    base = f"{tempfile.mkdtemp(prefix='riskloom-code-')}/riskloom"
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", package.parent, package.name))
    _SHIPPED.add(application)
