"""Small driver-side files in any file system that Spark reaches."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file; None when there is none."""
    if not exists(spark, path):
        return None
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see the old content or the new, never a part.

    The text goes to a new name first and takes the place by one rename, which HDFS
    and local file systems do in one step.
    """
    fresh = f"{path}.{uuid.uuid4().hex}"
    stream = _system(spark, fresh).create(_path(spark, fresh), False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, fresh).toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(_path(spark, fresh), _path(spark, path), options)


def delete(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)


def listing(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change) of files, sorted."""
    found = []
    for path in sorted(paths):
        status = _system(spark, path).getFileStatus(_path(spark, path))
        found.append((path, status.getLen(), status.getModificationTime()))
    return found
