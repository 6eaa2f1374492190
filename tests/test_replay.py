"""Loads that are repeated, lost or followed by expiry."""

from pyspark.sql import functions as F

from hiremill.operators import upsert
from hiremill.plans import medallion
from hiremill.schemas import CHANGES, JOBS, SILVER
from hiremill.sources.snapshots import expire_snapshots, next_version, read_snapshot, write_snapshot
from hiremill.streaming import arrivals

A = ("000000000001", "k", "a", "c", "d" * 120)
B = ("000000000002", "k", "b", "c", "d" * 120)
C = ("000000000003", "k", "a", "c", "d" * 120)


def records(spark, *rows):
    return spark.createDataFrame(rows, SILVER)


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    batch = records(spark, A, B, C)
    arrivals.load_once(batch, root, "s-0")
    tagged = read_snapshot(spark, f"{root}/jobs", JOBS).withColumn("tech_stack", F.lit("go"))
    write_snapshot(tagged, f"{root}/jobs", next_version(spark, f"{root}/jobs", f"{root}/changes"))
    arrivals.load_once(batch, root, "s-0")
    (job,) = arrivals.loaded_jobs(spark, root).collect()
    assert (job.job_title, job.tech_stack) == ("a", "go")
    assert [r.action for r in medallion.change_log(spark, root).orderBy("doc_key").collect()] == ["insert", "update", "update"]
    arrivals.load_once(records(spark, B), root, "s-1")
    assert arrivals.loaded_jobs(spark, root).first().job_title == "b"


def test_the_log_outlives_the_versions(spark, tmp_path):
    root = str(tmp_path)
    for i, row in enumerate((A, B, C)):
        arrivals.load_once(records(spark, row), root, f"s-{i}")
    expire_snapshots(spark, f"{root}/jobs", keep=1)
    assert medallion.change_log(spark, root).count() == 3
    arrivals.load_once(records(spark, A), root, "s-0")
    assert medallion.change_log(spark, root).count() == 3


def test_a_lost_load_leaves_no_entry(spark, tmp_path):
    root = str(tmp_path)
    arrivals.load_once(records(spark, A), root, "s-0")
    # The load dies between its two writes; then another stage writes the jobs.
    staged, prior = upsert.stage(records(spark, B)), read_snapshot(spark, f"{root}/jobs", JOBS)
    write_snapshot(upsert.upsert_actions(staged, prior), f"{root}/changes", next_version(spark, f"{root}/jobs", f"{root}/changes"))
    medallion.profile(spark, root)
    assert [r.doc_key for r in medallion.change_log(spark, root).collect()] == [A[0]]
    arrivals.load_once(records(spark, B), root, "s-1")
    assert sorted(r.doc_key for r in medallion.change_log(spark, root).collect()) == [A[0], B[0]]
    assert read_snapshot(spark, f"{root}/changes", CHANGES).count() == 1
