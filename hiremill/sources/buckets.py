"""A table kept in hash buckets of its key, of which a load replaces only those it touches.

The table is one folder of Parquet, partitioned by ``bucket``. New rows of some buckets are
published with Spark's dynamic partition overwrite, which leaves all other folders
untouched. Each bucket holds one row that stands for the bucket itself (``present`` is
false), so one that loses all its rows is replaced as well.

A batch goes through three committed writes: its buckets and its changes under
``pending``, then the table and the change log, then its name in ``batches``. Only the last makes it count.
A batch that was lost before ``pending`` was complete has touched nothing and starts anew; one that was lost later is published
again from ``pending``, which gives the same files' content. A batch that counts is never loaded again.

One writer at a time. Readers during a publication may see some buckets before and
some after it; ``pending`` of the batch says so until its name is in ``batches``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
BATCHES = T.StructType([T.StructField("batch", T.StringType()), T.StructField("buckets", T.LongType())])


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def committed(spark: SparkSession, path: str) -> bool:
    """Did a whole write to this folder commit? (Dynamic partition overwrite leaves no such sign.)"""
    return exists(spark, f"{path}/_SUCCESS")


def bucket_of(buckets: int, *columns: str) -> Column:
    """The bucket of a row by the first of ``columns`` that is not NULL: rows without a key spread by the next column."""
    return F.pmod(F.xxhash64(F.coalesce(*columns, F.lit(""))), F.lit(buckets)).cast("int")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


class BucketTable:
    """Rows of ``schema`` under ``root``/``name`` in ``buckets`` buckets of ``keys`` (fixed by the first load), with a change log."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, changes: T.StructType, keys: tuple[str, ...], buckets: int = BUCKETS):
        self.spark, self.root, self.schema, self.changes_schema, self.keys = spark, root, schema, changes, keys
        first = self.batches().select("buckets").head(1)
        self.buckets = first[0]["buckets"] if first else buckets

    def batches(self) -> DataFrame:
        """The batches that count."""
        path = f"{self.root}/batches"
        return self.spark.read.schema(BATCHES).parquet(path) if committed(self.spark, path) else self.spark.createDataFrame([], BATCHES)

    def holds(self, batch: str) -> bool:
        return bool(self.batches().filter(F.col("batch") == batch).head(1))

    def _all(self) -> DataFrame:
        path = f"{self.root}/table"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], f"{_ddl(self.schema)}, present boolean, bucket int")
        return self.spark.read.schema(f"{_ddl(self.schema)}, present boolean, bucket int").parquet(path)

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The rows, of some buckets only if given: other folders are not listed into the scan."""
        rows = self._all() if buckets is None else self._all().filter(F.col("bucket").isin(buckets))
        return rows.filter("present").select(*self.schema.fieldNames())

    def changes(self) -> DataFrame:
        """The change log of every batch that counts."""
        path = f"{self.root}/changes"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], self.changes_schema)
        rows = self.spark.read.schema(f"{_ddl(self.changes_schema)}, batch string").parquet(path)
        return rows.join(self.batches().select("batch"), "batch", "left_semi").select(*self.changes_schema.fieldNames())

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that rows with the key columns fall into: at most ``buckets`` numbers."""
        return sorted(r["b"] for r in rows.select(bucket_of(self.buckets, *self.keys).alias("b")).distinct().collect())

    def _write(self, rows: DataFrame, path: str, by: str, mode: str = "overwrite") -> None:
        writer = rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(by)
        writer.parquet(path)

    def replace(self, batch: str, buckets: list[int], rows: DataFrame, changes: DataFrame) -> None:
        """Make ``rows`` the whole content of ``buckets`` and add ``changes`` to the log, as ``batch``; nothing if the batch counts already.

        ``rows`` may read the table. A batch of this name that was lost half way is brought to its
        end first, with what it had computed then.
        """
        if self.holds(batch):
            return
        pending = f"{self.root}/pending/{batch}"
        if not committed(self.spark, f"{pending}/changes"):
            placed = rows.select(*self.schema.fieldNames(), F.lit(True).alias("present"), bucket_of(self.buckets, *self.keys).alias("bucket"))
            nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields]
            marks = self.spark.range(len(buckets)).select(
                *nothing, F.lit(False).alias("present"), F.element_at(F.array(*map(F.lit, buckets)), (F.col("id") + 1).cast("int")).alias("bucket")
            ) if buckets else None
            whole = placed.filter(F.col("bucket").isin(buckets)).unionByName(marks) if buckets else placed.filter(F.lit(False))
            whole.hint("rebalance", "bucket").write.mode("overwrite").parquet(f"{pending}/rows")
            changes.select(*self.changes_schema.fieldNames()).write.mode("overwrite").parquet(f"{pending}/changes")
        self.publish(batch)

    def publish(self, batch: str) -> None:
        """From ``pending`` to the table and the log, then the batch's name. Can be done again at any point."""
        pending = f"{self.root}/pending/{batch}"
        rows = self.spark.read.schema(f"{_ddl(self.schema)}, present boolean, bucket int").parquet(f"{pending}/rows")
        self._write(rows.hint("rebalance", "bucket"), f"{self.root}/table", "bucket")
        changes = self.spark.read.schema(self.changes_schema).parquet(f"{pending}/changes")
        self._write(changes.withColumn("batch", F.lit(batch)), f"{self.root}/changes", "batch")
        self.spark.createDataFrame([(batch, self.buckets)], BATCHES).coalesce(1).write.mode("append").parquet(f"{self.root}/batches")

    def unfinished(self, batch: str) -> bool:
        """Was this batch computed, but does it not count yet?"""
        return not self.holds(batch) and committed(self.spark, f"{self.root}/pending/{batch}/changes")
