"""Small text files through the file system that Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def resolved(spark: SparkSession, path: str):
    """The file system of a path and the qualified path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def qualified(spark: SparkSession, path: str) -> str:
    return resolved(spark, path)[1].toString()


def write_text(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """Write ``folder``/``name``; it appears under its name when it is whole."""
    fs, part = resolved(spark, f"{folder}/.{name}")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(part, resolved(spark, f"{folder}/{name}")[1]):
        raise RuntimeError(f"{folder}/{name} cannot be written")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = resolved(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds, but hidden files; nothing if it is missing."""
    fs, p = resolved(spark, folder)
    found = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n for n in found if not n.startswith((".", "_")))
