"""Session settings that the stateful operators need."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Folders made by ``run_dir`` that have not been cleared.
_made: list[str] = []

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Use the RocksDB state store for queries started inside the block.

    A running query keeps the provider it was started with, so the session's own
    value can be put back at once.
    """
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors can reach: ``spark.checkpoint.dir`` of the session.

    Where that is not set, a folder below the warehouse, which has to be shared as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_framewise"


def run_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder below the shared one."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear_run_dirs(spark: SparkSession) -> None:
    """Delete the folders that this process has made below the shared one.

    For the end of a job: DataFrames that read them cannot be used any more.
    """
    while _made:
        _delete(spark, _made.pop())


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def written(df: DataFrame, name: str):
    """``df`` from a table in the shared folder, which goes when the block ends.

    For a micro-batch that is used several times: it is computed once, also if executors are lost.
    """
    path = run_dir(df.sparkSession, name)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        _made.remove(path)
        _delete(df.sparkSession, path)


def write_through(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table below the shared folder and read it back from there.

    What follows may use the rows several times, prunes columns, and does not depend on
    executors that have been lost since.
    """
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
