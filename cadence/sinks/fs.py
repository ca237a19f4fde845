"""Thin helpers over the Hadoop FileSystem of a path (scheme-aware: hdfs, s3a, file...)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, src: str, dst: str, make_parent: bool = True) -> None:
    fs, s = _path(spark, src)
    _, d = _path(spark, dst)
    if make_parent:
        fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise RuntimeError(f"rename failed: {src} -> {dst}")


def touch(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.create(p, True).close()


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty if it does not exist)."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths matching a glob pattern (one listing call)."""
    fs, p = _path(spark, pattern)
    found = fs.globStatus(p)
    return sorted(st.getPath().toString() for st in found) if found else []
