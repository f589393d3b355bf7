"""Shared scratch space and small file-system helpers.

Intermediate tables go to the folder the cluster names in `spark.checkpoint.dir`, so a
lost executor (or a driver on another machine) can still read them. A session without that
setting uses a folder of its warehouse, which is as shared as its tables are.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch").rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path nobody else uses; nothing is created yet."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def settled(df: DataFrame, path: str) -> DataFrame:
    """`df` written once and read back.

    Cuts the lineage like a checkpoint, but stays columnar, so later reads can prune.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, purpose: str = "stage"):
    """`df` settled for the length of a block, for plans that would run it several times."""
    path = new_folder(df.sparkSession, purpose)
    try:
        yield settled(df, path)
    finally:
        delete(df.sparkSession, path)


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; none when it is missing."""
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole: written beside its place, then renamed."""
    beside, fs = _path(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(beside)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(beside, _path(spark, path)[0]):
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
