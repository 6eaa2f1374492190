"""Incremental load: records that arrive in a folder are upserted batch by batch."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from hiremill.plans.medallion import is_loaded, load_records
from hiremill.schemas import JOBS, SILVER
from hiremill.session import materialize
from hiremill.sources.snapshots import read_snapshot


def read_silver_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None, **options: str) -> DataFrame:
    """Silver Parquet files as a stream, oldest first."""
    reader = spark.readStream.schema(SILVER).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def load_stream(records: DataFrame, root: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Upsert each micro-batch into the snapshots under ``root``.

    A micro-batch that is replayed after a failure is skipped if its load took
    effect: loads carry the name of the stream's checkpoint and the batch number.
    Records of a key must arrive in ``doc_key`` order across batches; inside a
    batch they are ordered here.
    """
    stream = hashlib.md5(checkpoint.encode()).hexdigest()

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        load_once(batch, root, f"{stream}-{batch_id}")

    writer = records.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def load_once(batch: DataFrame, root: str, name: str) -> None:
    """Load a named batch unless a load of that name took effect. The batch is written once, since a load reads it several times."""
    spark = batch.sparkSession
    if not is_loaded(spark, root, name):
        load_records(spark, materialize(batch, "arrived"), root, name)


def loaded_jobs(spark: SparkSession, root: str) -> DataFrame:
    return read_snapshot(spark, f"{root}/jobs", JOBS)
