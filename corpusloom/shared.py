"""Folder that all executors share, for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_MADE: list[list[str]] = []


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only in local mode, where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not _is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="corpusloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a path, by the cluster's own configuration."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def materialised(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: a cut lineage that survives lost executors.

    The table goes when the application ends, or at the end of the `intermediates` block
    that it was made in.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    fs, p = hadoop_path(spark, path)
    fs.deleteOnExit(p)
    df.write.parquet(path)
    if _MADE:
        _MADE[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Deletes the intermediate tables made inside the block at its end; results must be written before."""
    _MADE.append([])
    try:
        yield
    finally:
        for path in _MADE.pop():
            fs, p = hadoop_path(spark, path)
            fs.delete(p, True)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings inside the block, for a plan that is executed in it; a double underscore stands for a dot."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
