"""Order over a whole table without sorting it in one task, and chunks of a hot key's records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hiremill.session import materialize

SAMPLES_PER_CHUNK = 16
#: Spark's row ids hold the partition from this bit on, and the row's place in it below.
PLACE_BITS = 33


# A key is first placed among every 16th cut point, then among the 16 that follow it.
CUTS_PER_GROUP = 16


def every_nth(items: Column, n: int) -> Column:
    """Each ``n``-th element of an array."""
    return F.filter(items, lambda _, i: i % n == n - 1)


def cut_table(samples: Column) -> Column:
    """``(cuts, heads)`` from an array of sampled keys: what :func:`chunk_of` looks a key up in."""
    cuts = every_nth(F.array_sort(samples), SAMPLES_PER_CHUNK)
    return F.struct(cuts.alias("cuts"), every_nth(cuts, CUTS_PER_GROUP).alias("heads"))


def chunk_of(key: Column, table: Column) -> Column:
    """Number of cut points at or below ``key``: grows with the key."""

    def below(points: Column) -> Column:
        return F.size(F.filter(points, lambda point: point <= key))

    passed = below(table["heads"]) * CUTS_PER_GROUP
    return passed + below(F.slice(table["cuts"], passed + 1, CUTS_PER_GROUP))


def number_rows(df: DataFrame, *order: Column | str, name: str = "row_index", chunks: int | None = None) -> DataFrame:
    """Add the 0-based position of each row in the order of ``order`` (a unique key).

    Spark's range partitioner deals the rows out, each partition is sorted where it is and
    written, so its boundaries are drawn once; a row's position is its place in its partition
    plus the row counts of the partitions before. Only these counts meet in one task.
    ``chunks`` fixes the number of partitions; else it is that of any shuffle, small ones joined.
    """
    keys = [(F.col(c) if isinstance(c, str) else c).alias(f"_k{i}") for i, c in enumerate(order)]
    names = [f"_k{i}" for i in range(len(keys))]
    keyed = df.select("*", *keys)
    dealt = keyed.repartitionByRange(chunks, *names) if chunks else keyed.repartitionByRange(*names)
    sorted_rows = dealt.sortWithinPartitions(*names).drop(*names).withColumn("_id", F.monotonically_increasing_id())
    placed = materialize(sorted_rows, "ordered").select(
        "*", F.shiftright("_id", PLACE_BITS).alias("_part"), F.col("_id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias("_place")
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select(F.col("_part").alias("_of"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    numbered = placed.join(starts, F.col("_part") == F.col("_of"))
    return numbered.withColumn(name, F.col("_start") + F.col("_place")).drop("_id", "_part", "_place", "_of", "_start")
