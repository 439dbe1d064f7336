"""Small files and moves on whatever file system a path names."""

from __future__ import annotations

import fnmatch

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, p = _at(spark, old)
    if not fs.rename(p, _at(spark, new)[1]):
        raise OSError(f"cannot rename {old} to {new}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """The whole file, complete before it takes its name."""
    fs, p = _at(spark, path + ".part")
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(_at(spark, path)[1], False)
    rename(spark, path + ".part", path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def listed(spark: SparkSession, folder: str, pattern: str = "*", below: bool = False) -> list[str]:
    """Sorted paths of the files in a folder, or anywhere below it, whose names match."""
    fs, p = _at(spark, folder)
    if not fs.exists(p):
        return []
    found, files = [], fs.listFiles(p, below)
    while files.hasNext():
        at = files.next().getPath()
        if fnmatch.fnmatchcase(at.getName(), pattern):
            found.append(at.toString())
    return sorted(found)


def copy(spark: SparkSession, source: str, target: str, move: bool = False) -> None:
    """One file, across file systems if need be; an older file of that name goes."""
    a, p = _at(spark, source)
    b, q = _at(spark, target)
    spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(a, p, b, q, move, True, spark.sparkContext._jsc.hadoopConfiguration())
