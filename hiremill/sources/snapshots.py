"""Versioned Parquet snapshots: a table is a folder of ``version=N`` folders.

A version counts once Spark's commit has left its ``_SUCCESS`` file, so readers
never see half a write and a table is never overwritten while it is read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hiremill.schemas import conform

_VERSION = re.compile(r"version=(\d+)$")
_EXPIRED = re.compile(r"expired=(\d+)$")


def _names(spark: SparkSession, path: str) -> list[str]:
    """The names of what is directly in a folder; none if it does not exist."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in fs.listStatus(root)] if fs.exists(root) else []


def _mark(spark: SparkSession, path: str) -> None:
    """Leave an empty folder as a sign."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def _versions(spark: SparkSession, path: str) -> list[tuple[int, bool]]:
    """``(number, committed)`` of each version folder, in order."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    root = hadoop(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        match = _VERSION.search(status.getPath().getName())
        if match:
            found.append((int(match.group(1)), fs.exists(hadoop(status.getPath(), "_SUCCESS"))))
    return sorted(found)


def latest_version(spark: SparkSession, path: str) -> int | None:
    return max((n for n, committed in _versions(spark, path) if committed), default=None)


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The table at its latest (or a given) version; empty if it was never written.

    Columns that an older version lacks read as NULL.
    """
    number = latest_version(spark, path) if version is None else version
    if number is None:
        return spark.createDataFrame([], schema)
    return conform(spark.read.parquet(f"{path}/version={number}"), schema)


def next_version(spark: SparkSession, *paths: str) -> int:
    """A number no table of ``paths`` has used; a folder left by a lost job is passed over, not reused."""
    return max((n for path in paths for n, _ in _versions(spark, path)), default=0) + 1


def write_snapshot(df: DataFrame, path: str, version: int | None = None) -> int:
    """Write ``df`` as the next (or the given new) version and return its number."""
    number = next_version(df.sparkSession, path) if version is None else version
    df.write.parquet(f"{path}/version={number}")
    return number


def effective_versions(spark: SparkSession, path: str) -> set[int]:
    """Numbers that were committed once, those expired since included."""
    expired = {int(m.group(1)) for m in map(_EXPIRED.search, _names(spark, path)) if m}
    return expired | {n for n, committed in _versions(spark, path) if committed}


def note_batch(spark: SparkSession, path: str, batch: str, version: int) -> None:
    """Say, before it is written, which version a batch will be."""
    _mark(spark, f"{path}/batch={batch}.version={version}")


def versions_of_batch(spark: SparkSession, path: str, batch: str) -> set[int]:
    """The versions a batch was to be; it took effect if one of them did."""
    start = f"batch={batch}.version="
    return {int(name.removeprefix(start)) for name in _names(spark, path) if name.startswith(start)}


def read_log(spark: SparkSession, path: str, schema: T.StructType, effective_in: str) -> DataFrame:
    """All versions of a log table that took effect, that is, whose number ``effective_in`` once committed too.

    The two tables share their numbers (``next_version`` over both), so no other
    write can have taken the number of a load that was lost.
    """
    done = effective_versions(spark, effective_in)
    folders = [f"{path}/version={n}" for n, committed in _versions(spark, path) if committed and n in done]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def expire_snapshots(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete all but the last ``keep`` committed versions; returns the numbers deleted."""
    committed = [n for n, done in _versions(spark, path) if done]
    old = committed[: -keep if keep > 0 else len(committed) - 1]
    for number in old:
        _mark(spark, f"{path}/expired={number}")
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version={number}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return old
