"""Files and folders of the shared store, through Hadoop's file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The Hadoop path and the file system that holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def found_paths(spark: SparkSession, pattern: str) -> list[str]:
    """What matches a pattern; nothing where nothing does."""
    where, files = file_system(spark, pattern)
    return [f.getPath().toString() for f in files.globStatus(where) or []]


def exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, or anything that matches a pattern, is there."""
    where, files = file_system(spark, pattern)
    found = files.globStatus(where)
    return found is not None and len(found) > 0


def drop_path(spark: SparkSession, pattern: str) -> None:
    """Delete what matches a pattern, if anything does."""
    where, files = file_system(spark, pattern)
    for found in files.globStatus(where) or []:
        files.delete(found.getPath(), True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file with ``text``, in place of an older one."""
    where, files = file_system(spark, path)
    out = files.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; raises where ``target`` is there already."""
    old, files = file_system(spark, source)
    new, _ = file_system(spark, target)
    files.mkdirs(new.getParent())
    if files.exists(new) or not files.rename(old, new):
        raise FileExistsError(f"can't move {source} to {target}")
