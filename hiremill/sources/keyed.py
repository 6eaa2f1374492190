"""A table sorted by its key, with Bloom filters in its files: small lookups read a small part of it.

Files follow the order of the key, so their ranges do not overlap; each row group has
statistics and a Bloom filter of the key. A lookup of few keys is pushed down to the scan as a list and
skips the row groups that hold none; a lookup of many is a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiremill.sources.buckets import committed

#: Keys that a lookup hands to the scan as a list; more are joined.
MOST_KEYS = 1000
#: Bytes of a row group: the unit that a lookup reads or skips.
GROUP_BYTES = 8 << 20


def write_keyed(df: DataFrame, path: str, key: str, files: int | None = None, group_bytes: int = GROUP_BYTES) -> None:
    """Write ``df`` in the order of ``key``."""
    dealt = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    writer = dealt.sortWithinPartitions(key).write.option("parquet.block.size", group_bytes)
    writer.option(f"parquet.bloom.filter.enabled#{key}", "true").mode("errorifexists").parquet(path)


def lookup(spark: SparkSession, path: str, keys: DataFrame, key: str, most_keys: int = MOST_KEYS) -> DataFrame:
    """The rows of ``keys``, each once however often it is asked for; a NULL key meets nothing."""
    if not committed(spark, path):
        raise FileNotFoundError(path)
    rows = spark.read.parquet(path)
    asked = keys.select(key).filter(F.col(key).isNotNull()).distinct()
    few = [r[0] for r in asked.limit(most_keys + 1).collect()]
    if len(few) > most_keys:
        return rows.join(asked, key, "left_semi")
    if not few:
        return rows.filter(F.lit(False))
    return rows.filter(F.col(key).isin(few))
