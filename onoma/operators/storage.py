"""Cutting lineage in the folder that the cluster shares."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where none is set, a local master gets a temporary folder, and a cluster is an error."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="onoma-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def checkpoint(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _at(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in any store that Spark reads."""
    at, fs = _at(spark, path)
    return fs.exists(at)


def qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark reports it for files below it."""
    at, fs = _at(spark, path)
    return fs.makeQualified(at).toString()


def empty_files(spark: SparkSession, path: str) -> list[str]:
    """The files below a path, or at it, that have no byte: Spark's readers pass over them."""
    at, fs = _at(spark, path)
    found, files = [], fs.listFiles(at, True)  # noqa: FBT003
    while files.hasNext():
        f = files.next()
        if f.getLen() == 0:
            found.append(f.getPath().toString())
    return found


def join_files(spark: SparkSession, folder: str, path: str, head: str | None = None) -> None:
    """The files of a folder, in the order of their names and below a first line, as one; the folder goes, and so does what the path's held."""
    at, fs = _at(spark, folder)
    to, out_fs = _at(spark, path)
    out_fs.delete(to.getParent(), True)  # noqa: FBT003
    out = out_fs.create(to)
    try:
        if head is not None:
            out.write(bytearray(f"{head}\n".encode()))
        for part in sorted(f.getPath().toString() for f in fs.listStatus(at) if f.getPath().getName().startswith("part-")):
            data = fs.open(spark._jvm.org.apache.hadoop.fs.Path(part))
            try:
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(data, out, 1 << 20, False)  # noqa: FBT003
            finally:
                data.close()
    finally:
        out.close()
    fs.delete(at, True)  # noqa: FBT003
