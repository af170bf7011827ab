"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_own_folders: dict[str, str] = {}

# Runtime settings the operators count on: UTC timestamps, a runtime plan that
# splits skewed join partitions even where the split costs a shuffle, state of streams off
# the heap, and small batches for Python workers.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # State of streams lies on local disks, not on the heap, and is saved as changes.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # What a Python worker gets at a time is bounded by bytes, not only by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine (tests) is a
    fresh temporary folder used; on a cluster that is an error, as executors do
    not see each other's folders.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="gladwire-")
    return _own_folders[app]


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder and read back.

    For results that several branches of a plan use: they are computed once,
    and a lost executor costs a read.
    """
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """As ``written``, for as long as the block lasts; the folder goes with its end."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(df.sparkSession, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder and what it holds, wherever Spark can write; a missing one is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_evolved(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet files of older and newer schemas as one table, in one scan.

    Columns that a file lacks come as nulls, integers and floats are widened to
    the asked type, and other columns are not read. A missing folder has no rows.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return spark.createDataFrame([], schema)
