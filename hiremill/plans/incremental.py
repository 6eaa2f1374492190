"""Loads into a jobs table kept in hash buckets: a load reads and rewrites only the buckets of its keys.

``load_batch`` is what ``medallion.load_records`` is for versioned tables: the same
actions and the same rows after it, at a cost that goes with the load's keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiremill.operators import decode, maintained, quality, upsert
from hiremill.schemas import BRONZE, CHANGES, JOBS, conform
from hiremill.session import materialize
from hiremill.sources.buckets import BUCKETS, BucketTable, bucket_of, committed
from hiremill.sources.files import file_stem


def jobs_table(spark: SparkSession, root: str, buckets: int = BUCKETS) -> BucketTable:
    """Jobs by ``source_id``; rows without one never meet and spread by their content."""
    return BucketTable(spark, root, JOBS, CHANGES, ("source_id", "content_hash"), buckets)


def put_table(table: BucketTable, rows: DataFrame, batch: str) -> None:
    """Lay in rows that were made elsewhere, into their buckets as a whole, without a change entry."""
    rows = conform(rows, JOBS)
    table.replace(batch, table.touched(rows), rows, table.spark.createDataFrame([], CHANGES))


def load_batch(table: BucketTable, records: DataFrame, batch: str, kept: BucketTable | None = None) -> DataFrame:
    """Upsert parsed records as ``batch``; returns the summary of all changes so far, nothing done if the batch counts already.

    ``kept`` is a table of measures (:func:`measures_table`) that takes the batch's deltas after it. The deltas are
    written before the jobs change, so a load that was lost between the two is brought to its end by its replay.
    """
    deltas = f"{table.root}/deltas/{batch}"
    if table.unfinished(batch):
        table.publish(batch)
    elif not table.holds(batch):
        staged = upsert.stage(materialize(records, "arrived"))
        touched = table.touched(staged)
        prior = table.read(touched)
        actions = materialize(upsert.upsert_actions(staged, prior), "actions")
        after = materialize(upsert.apply_changes(prior, staged, actions), "jobs-after")
        if kept is not None:
            place = bucket_of(table.buckets, *table.keys).alias("bucket")
            own = maintained.measures(maintained.signed_rows(prior, after, actions.filter("action <> 'skip'")))
            least = maintained.shortest_by_bucket(prior.select("*", place), after.select("*", place))
            own.unionByName(least).filter("n <> 0 or total <> 0").write.mode("overwrite").parquet(deltas)
        table.replace(batch, touched, after, actions)
    if kept is not None:
        if kept.unfinished(batch):
            kept.publish(batch)
        elif not kept.holds(batch) and committed(table.spark, deltas):
            new = table.spark.read.schema(maintained.MEASURES).parquet(deltas)
            touched = kept.touched(new)
            kept.replace(batch, touched, maintained.merged(kept.read(touched), new), table.spark.createDataFrame([], CHANGES))
    return upsert.load_summary(records, table.changes())


def measures_table(spark: SparkSession, root: str, buckets: int = BUCKETS) -> BucketTable:
    """What ``maintained`` keeps, by name."""
    return BucketTable(spark, root, maintained.MEASURES, CHANGES, ("name", "kind"), buckets)


#: What stands in bronze, and when its file was written.
BRONZE_FILES = T.StructType([*BRONZE.fields, T.StructField("modified", T.TimestampType())])


def bronze_table(spark: SparkSession, root: str, buckets: int = BUCKETS) -> BucketTable:
    return BucketTable(spark, root, BRONZE_FILES, CHANGES, ("doc_key",), buckets)


def ingest_archives(table: BucketTable, archives: DataFrame, batch: str) -> None:
    """Decode ``(doc_key, content, modified)`` into bronze: each row takes the place of its key's earlier one, other keys stay."""
    if table.holds(batch):
        return
    if table.unfinished(batch):
        table.publish(batch)
        return
    times = archives.select("doc_key", "modified")
    decoded = materialize(decode.decode_mhtml(archives.select("doc_key", "content")).join(times, "doc_key"), "decoded")
    touched = table.touched(decoded)
    others = table.read(touched).join(decoded.select("doc_key"), "doc_key", "left_anti")
    table.replace(batch, touched, others.unionByName(conform(decoded, BRONZE_FILES)), table.spark.createDataFrame([], CHANGES))


def ingest_folder(table: BucketTable, folder: str, batch: str, pattern: str = "*.mhtml") -> int:
    """Decode the archives of a folder that are new or written again since the last ingest; returns how many.

    Files written before the newest one ingested are not opened: the time is pushed down to the file scan. Of those
    written since, the ones that bronze holds with the same time are left out. A file moved in
    with an older time than that is not seen; give it a new time, or ingest it by :func:`ingest_archives`.
    """
    files = table.spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    held = table.read().select("doc_key", "modified")
    newest = held.agg(F.max("modified").alias("newest")).first()["newest"]
    if newest is not None:
        files = files.filter(F.col("modificationTime") >= F.lit(newest))
    archives = files.select(file_stem(F.col("path")).alias("doc_key"), "content", F.col("modificationTime").alias("modified"))
    new = materialize(archives.join(held.filter(F.col("modified") == F.lit(newest)), ["doc_key", "modified"], "left_anti") if newest is not None else archives, "archives")
    count = new.count()
    if count or table.unfinished(batch):
        ingest_archives(table, new, batch)
    return count


def label_table(table: BucketTable, quarantine: BucketTable, batch: str) -> DataFrame:
    """Label all jobs and move LOW ones to ``quarantine``, bucket by bucket; returns the report row over both.

    Every bucket may change, so this is a whole pass. The quarantine is replaced first: what a
    lost pass has moved there is still in the table.
    """
    every = list(range(table.buckets))
    nothing = table.spark.createDataFrame([], CHANGES)
    if not table.holds(batch):
        labelled = quality.label_jobs(table.read())
        quarantine.replace(batch, every, quality.low_quality(labelled), nothing)
        table.replace(batch, every, quality.high_quality(labelled), nothing)
    return quality.quality_report(table.read().unionByName(quarantine.read()))
