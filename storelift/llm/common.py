"""Small helpers shared by the operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

# ASCII white space of the word and line contracts, 0x20 and 0x09-0x0D.
ASCII_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read through Spark (any file system Spark knows)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per Spark application.

    Functions that run in tasks are sent by reference, so workers must be able
    to import them; this makes it so however the application was started.
    """
    sc = spark.sparkContext
    if getattr(sc, "_storelift_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="storelift-py-"), "storelift.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    sc._storelift_shipped = True


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, vectorised over uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def to_long(x: np.ndarray) -> np.ndarray:
    """uint64 as Spark's signed long."""
    return x.view(np.int64)


def text_groups(texts: list[str | None], limit: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, UTF-8 texts) in groups of about ``limit``
    bytes, so that the arrays computed over a group stay small."""
    first, group, size = 0, [], 0
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        if group and size + len(data) > limit:
            yield first, group
            first, group, size = i, [], 0
        group.append(data)
        size += len(data)
    if group:
        yield first, group
