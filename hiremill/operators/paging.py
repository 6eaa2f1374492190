"""Pages of a table that is kept in the order in which it is shown.

The rows are written once, dealt out by Spark's range partitioner and sorted in each partition, one folder
``part=...`` a partition, with a table of the parts: row count, rows before it, and its last
row's key. A page is then a filter: by position it reads the parts that its positions
fall into, by key those from the last row shown on. Nothing is sorted but the page.

Order is NULL first in each column. Rows equal in every column of the order keep the place they were written at, so
pages neither repeat nor miss one. The table's own columns must not be named ``place`` or ``part``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from hiremill.operators.ordering import PLACE_BITS

#: Where a row stands: its part's number, and its place in it in the lower bits.
PLACE = "place"


def write_pages(rows: DataFrame, path: str, order: list[str], parts: int | None = None) -> None:
    """Write ``rows`` in the order of the columns ``order`` under a new folder."""
    keys = [F.asc_nulls_first(c) for c in order]
    dealt = rows.repartitionByRange(parts, *keys) if parts else rows.repartitionByRange(*keys)
    placed = dealt.sortWithinPartitions(*keys).withColumn(PLACE, F.monotonically_increasing_id())
    placed.withColumn("part", F.shiftright(PLACE, PLACE_BITS)).write.partitionBy("part").parquet(f"{path}/rows")
    spark, whole = rows.sparkSession, StructType([*rows.schema.fields, StructField(PLACE, LongType()), StructField("part", LongType())])
    written = spark.read.schema(whole).parquet(f"{path}/rows")
    sizes = written.groupBy("part").agg(F.count("*").alias("_rows"), F.max(F.struct(*order, PLACE)).alias("last"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each part meets in one task here.
    start = F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("start")
    # A page without rows takes its columns from here.
    starts = sizes.select("part", "_rows", start, "last", F.lit(None).cast(StructType(whole.fields[:-1])).alias("row"))
    starts.coalesce(1).write.parquet(f"{path}/parts")


def _read(spark: SparkSession, path: str, parts: list[int]) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").filter(F.col("part").isin(parts))


def _none(spark: SparkSession, path: str) -> DataFrame:
    """What lies past the end: no rows, with the columns of the others."""
    return spark.read.parquet(f"{path}/parts").limit(0).select("row.*")


def page_at(spark: SparkSession, path: str, offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` to ``offset + limit``, in order."""
    until = offset + limit
    hit = spark.read.parquet(f"{path}/parts").filter((F.col("start") < until) & (F.col("start") + F.col("_rows") > offset))
    # Each part holds rows, so this is at most one for each row of the page.
    starts = {r["part"]: r["start"] for r in hit.select("part", "start").collect()}
    if not starts:
        return _none(spark, path)
    within = _either([(F.col("part") == part) & _places(part, offset - start, until - start) for part, start in starts.items()])
    return _read(spark, path, sorted(starts)).filter(within).orderBy(PLACE).limit(limit).drop("part")


def _places(part: int, low: int, high: int) -> Column:
    base = part << PLACE_BITS
    return F.col(PLACE).between(base + max(low, 0), base + high - 1)


def _either(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def page_after(spark: SparkSession, path: str, order: list[str], shown: Row | None, limit: int) -> DataFrame:
    """The next ``limit`` rows after the row ``shown`` (the last of the page before; None: from the start)."""
    parts = spark.read.parquet(f"{path}/parts")
    if shown is not None:
        types = parts.schema["last"].dataType
        key = F.struct(*[F.lit(shown[c]).cast(types[c].dataType).alias(c) for c in (*order, PLACE)])
        parts = parts.filter(F.col("last") > key)
    # Of the first part one row or more is left, so the page ends within the parts that start less than ``limit - 1`` rows after its end.
    first = parts.orderBy("part").head(1)
    if not first:
        return _none(spark, path)
    reach = first[0]["start"] + first[0]["_rows"] + limit - 1
    touched = [r["part"] for r in parts.filter((F.col("part") == first[0]["part"]) | (F.col("start") < reach)).select("part").collect()]
    rows = _read(spark, path, sorted(touched))
    if shown is not None:
        rows = rows.filter(F.struct(*order, PLACE) > key)
    return rows.orderBy(PLACE).limit(limit).drop("part")
