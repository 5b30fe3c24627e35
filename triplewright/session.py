"""Where intermediate files may go."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Spark deletes a query's shuffle files at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share for intermediate files.

    ``spark.checkpoint.dir`` names it. Only a local session may leave that unset: it then
    uses a folder below its warehouse.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return shared.rstrip("/")


_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder of the run, if there is one, or in the shared folder."""
    return f"{_run_folder.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder of its own for the intermediate files of a run, deleted at its end."""
    path = scratch_path(spark, "run")
    token = _run_folder.set(path)
    try:
        yield path
    finally:
        _run_folder.reset(token)
        remove_folder(spark, path)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Queries that begin meanwhile run with another value of a setting."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Queries that begin meanwhile delete their shuffle files at their end.

    By default these stay until the driver happens to collect its garbage, so that a chain of
    written tables holds the shuffles of all of them on disk.
    """
    with setting(spark, SHUFFLE_CLEANUP, "true"):
        yield


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder, or to ``path``, and read it back.

    Cuts the lineage, survives lost executors, and gives Catalyst real sizes. Shuffle files of
    the query are deleted, as what they led to is written.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    with shuffles_deleted(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through the Hadoop file system it lies in."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)
