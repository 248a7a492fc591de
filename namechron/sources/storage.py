"""The folder that driver and executors share, and tables written to it to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own_dirs: dict[str, str] = {}
_own_folders: set[str] = set()
_open_scratches: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or what was set as checkpoint folder.

    Where neither is set a session on one machine gets a temporary folder; on a cluster that is an error.
    """
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _own_dirs:
        _own_dirs[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="namechron-shared-")
    return _own_dirs[context.applicationId]


def _hadoop_path(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses; it goes when the application ends, or with :func:`scratch`."""
    folder = f"{shared_dir(spark)}/namechron/{spark.sparkContext.applicationId}"
    if folder not in _own_folders:
        jpath, files = _hadoop_path(spark, folder)
        files.mkdirs(jpath)
        files.deleteOnExit(jpath)
        _own_folders.add(folder)
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    for made in _open_scratches:
        made.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Paths made inside; they are deleted at the end, except those that the caller takes off the list."""
    made: list[str] = []
    _open_scratches.append(made)
    try:
        yield made
    finally:
        _open_scratches[:] = [m for m in _open_scratches if m is not made]
        delete(spark, made)


def delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        jpath, files = _hadoop_path(spark, path)
        files.delete(jpath, True)


def materialize(df: DataFrame, name: str, rows_in_file: int = 0) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    Spark holds up to 4,096 rows of a file at once, written or read; ``rows_in_file`` bounds that for wide rows.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").option("maxRecordsPerFile", rows_in_file).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
