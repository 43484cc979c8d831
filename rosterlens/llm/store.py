"""Shared folders for tables that cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the parquet tables under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_TEMPORARY: dict[str, str] = {}
_WRITTEN: WeakKeyDictionary = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a temporary folder in local mode and an error on a cluster."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = _TEMPORARY.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="rosterlens-"))
    return path.rstrip("/")


def _folder(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(context._jsc.hadoopConfiguration())


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    Later jobs then start from files every executor can read, so a lost executor
    costs only its running tasks. A table that ``discard`` doesn't get is deleted when the
    driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/t-{uuid.uuid4().hex}"
    df.write.parquet(path)
    folder, system = _folder(spark, path)
    system.deleteOnExit(folder)
    out = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` wrote and that nothing reads any more; others are left alone."""
    for df in tables:
        path = _WRITTEN.pop(df, None)
        if path:
            folder, system = _folder(df.sparkSession, path)
            system.delete(folder, True)
