"""The batch stages over one root folder: ingest, process, load, profile, or all.

    spark-submit -m hiremill.plans.medallion all --source <folder> --root <folder>

``root`` holds the tables ``bronze`` and ``silver`` (rewritten by each run) and
the versioned ``jobs``, ``jobs_quarantine`` and ``changes``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiremill.operators import decode, quality, silver, upsert
from hiremill.schemas import BRONZE, CHANGES, JOBS, REJECTS, SILVER
from hiremill.session import build_session, materialize
from hiremill.sources.files import scan_mhtml, scan_records
from hiremill.sources.snapshots import (
    effective_versions,
    next_version,
    note_batch,
    read_log,
    read_snapshot,
    versions_of_batch,
    write_snapshot,
)

STAGES = ("ingest", "process", "load", "profile")


def ingest(spark: SparkSession, source: str | DataFrame, root: str) -> DataFrame:
    """Archives, a folder of them or ``(doc_key, content)``, to bronze; returns the summary row."""
    archives = scan_mhtml(spark, source) if isinstance(source, str) else source
    decode.decode_mhtml(archives).write.mode("overwrite").parquet(f"{root}/bronze")
    return decode.bronze_summary(spark.read.schema(BRONZE).parquet(f"{root}/bronze"))


def process(spark: SparkSession, root: str) -> DataFrame:
    """Bronze to silver: one write, split into ``valid=true`` records and ``valid=false`` rejects."""
    bronze = spark.read.schema(BRONZE).parquet(f"{root}/bronze")
    pages = bronze.filter("error_kind is null").select("doc_key", "html")
    checked = silver.check_listings(decode.extract_listings(pages)).withColumn("valid", F.col("bad_field").isNull())
    checked.write.mode("overwrite").partitionBy("valid").parquet(f"{root}/silver")
    return silver.silver_summary(_silver(spark, root))


def _silver(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(f"{_ddl(SILVER)}, bad_field string, valid boolean").parquet(f"{root}/silver")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


def valid_records(spark: SparkSession, root: str) -> DataFrame:
    return _silver(spark, root).filter("valid").select(*SILVER.fieldNames())


def rejected_records(spark: SparkSession, root: str) -> DataFrame:
    return _silver(spark, root).filter("not valid").select(*REJECTS.fieldNames())


def load_records(spark: SparkSession, records: DataFrame, root: str, batch: str | None = None) -> DataFrame:
    """Upsert parsed records into ``jobs``; the change log is written first and drives the table.

    Both take the same version number: a change version takes effect with the
    jobs version of that number, so a load that is lost half way leaves no entry.
    The number a named ``batch`` takes is noted before it is written.
    """
    staged = upsert.stage(records)
    prior = read_snapshot(spark, f"{root}/jobs", JOBS)
    version = next_version(spark, f"{root}/jobs", f"{root}/changes")
    if batch is not None:
        note_batch(spark, f"{root}/batches", batch, version)
    write_snapshot(upsert.upsert_actions(staged, prior), f"{root}/changes", version)
    actions = read_snapshot(spark, f"{root}/changes", CHANGES, version)
    write_snapshot(upsert.apply_changes(prior, staged, actions), f"{root}/jobs", version)
    return upsert.load_summary(records, actions)


def is_loaded(spark: SparkSession, root: str, batch: str) -> bool:
    """Did a load of this batch take effect?"""
    return bool(versions_of_batch(spark, f"{root}/batches", batch) & effective_versions(spark, f"{root}/jobs"))


def change_log(spark: SparkSession, root: str) -> DataFrame:
    """``(doc_key, source_id, content_hash, action)`` of every load that took effect."""
    return read_log(spark, f"{root}/changes", CHANGES, effective_in=f"{root}/jobs")


def load(spark: SparkSession, root: str, json_folder: str | None = None) -> DataFrame:
    """Load the silver table, or a folder of JSON records in its place."""
    if json_folder:
        return load_records(spark, materialize(scan_records(spark, json_folder), "records"), root)
    return load_records(spark, valid_records(spark, root), root)


def profile(spark: SparkSession, root: str) -> DataFrame:
    """Label all jobs, move LOW ones to quarantine (replacing it), return the report row.

    The label depends on its row alone, so both tables are filtered from the
    same snapshot and the report is read from what was written.
    """
    labelled = quality.label_jobs(read_snapshot(spark, f"{root}/jobs", JOBS))
    low = write_snapshot(quality.low_quality(labelled), f"{root}/jobs_quarantine")
    # A number that a lost load took in the change log is not used again.
    number = next_version(spark, f"{root}/jobs", f"{root}/changes")
    high = write_snapshot(quality.high_quality(labelled), f"{root}/jobs", number)
    parts = [read_snapshot(spark, f"{root}/{t}", JOBS, v) for t, v in (("jobs", high), ("jobs_quarantine", low))]
    return quality.quality_report(parts[0].unionByName(parts[1]))


def run_stage(spark: SparkSession, stage: str, root: str, source: str | DataFrame | None = None) -> dict[str, DataFrame]:
    """Run one stage, or ``all`` in order; returns the summary of each stage that ran."""
    if stage not in (*STAGES, "all"):
        raise ValueError(f"unknown stage {stage!r}; choose one of {', '.join(STAGES)} or all")
    wanted = STAGES if stage == "all" else (stage,)
    if "ingest" in wanted and source is None:
        raise ValueError("the ingest stage needs a source folder")
    steps = {
        "ingest": lambda: ingest(spark, source, root),
        "process": lambda: process(spark, root),
        "load": lambda: load(spark, root),
        "profile": lambda: profile(spark, root),
    }
    return {name: steps[name]() for name in wanted}


def main() -> None:
    parser = argparse.ArgumentParser(prog="hiremill")
    parser.add_argument("stage", choices=[*STAGES, "all"])
    parser.add_argument("--root", required=True)
    parser.add_argument("--source")
    args = parser.parse_args()
    for name, summary in run_stage(build_session(), args.stage, args.root, args.source).items():
        print(name, summary.first().asDict())


if __name__ == "__main__":
    main()
