"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_collecting: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, a local master gets one of its own; on a
    cluster that is an error, as other machines could not read it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that driver and executors share (master: {master})")
    own = tempfile.mkdtemp(prefix="zonewright-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def staged(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read back: it is computed once, and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    for paths in _collecting:
        paths.append(path)
    return out


@contextlib.contextmanager
def collected() -> Iterator[list[str]]:
    """The folders that are staged within: for remove(), once what is made from them is written itself."""
    paths: list[str] = []
    _collecting.append(paths)
    try:
        yield paths
    finally:
        _collecting.remove(paths)


def remove(spark: SparkSession, paths: list[str]) -> None:
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Delete the folders of staged tables that nothing reads any more."""
    for df in tables:
        remove(df.sparkSession, [df.staged_at])
