"""A shared folder for tables that must not change between two readings."""

from __future__ import annotations

import re
import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


#: Rows of a table that one task of a shuffle takes, so that its memory doesn't follow the table's size.
ROWS_A_TASK = 400_000
_WRITTEN: WeakKeyDictionary = WeakKeyDictionary()
_TEMPORARY: dict[str, str] = {}


def pinned_root(spark: SparkSession) -> str:
    """A new folder's path under ``spark.checkpoint.dir``; where that is unset, in a temporary folder in local mode and an error on a cluster. What it holds goes when the driver ends."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = _TEMPORARY.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="rosterlens-"))
    path = f"{root.rstrip('/')}/p-{uuid.uuid4().hex}"
    folder, system = _folder(spark, path)
    system.deleteOnExit(folder)
    return path


def _folder(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def tasks_for(df: DataFrame) -> int:
    """Partitions for a shuffle of ``df``, at most ``ROWS_A_TASK`` rows each on average. A number that is named isn't coalesced: adaptive execution packs by compressed bytes, and rows of whole numbers take 40 times these in memory."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_A_TASK))


def dealt(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt by ``key`` into tasks by rows, if it has more rows than one task should take."""
    return df.repartition(tasks_for(df), key) if df.count() > ROWS_A_TASK else df


def spread(df: DataFrame, key: str, rows: int) -> DataFrame:
    """``df`` dealt by ``key`` into tasks of at most ``rows`` rows on average. Files are read by bytes, and a few bytes of each row can ask for much work."""
    return df.repartition(max(1, -(-df.count() // rows)), key)


def pinned(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = pinned_root(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _WRITTEN[out] = path
    return out


def unpinned(*tables: DataFrame) -> None:
    """Delete tables that ``pinned`` wrote and that nothing reads any more."""
    for df in tables:
        path = _WRITTEN.pop(df, None)
        if path:
            dropped(df.sparkSession, path)


def dropped(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``pinned_root`` named."""
    folder, system = _folder(spark, path)
    system.delete(folder, True)
