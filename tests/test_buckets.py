"""The jobs table in buckets: what a load writes, replays, and losses on the way."""

import os

import pytest
from pyspark.sql import functions as F

from hiremill.operators import upsert
from hiremill.plans import incremental
from hiremill.plans.incremental import jobs_table, label_table, load_batch, put_table
from hiremill.schemas import JOBS, SILVER
from hiremill.sources.buckets import BucketTable

LONG = "d" * 120


def records(spark, rows):
    return spark.createDataFrame([(f"{i:012d}", key, title, "c", LONG) for i, (key, title) in enumerate(rows)], SILVER)


def files(root):
    """File and time of writing, by bucket."""
    found = {}
    for folder in os.listdir(f"{root}/table"):
        if folder.startswith("bucket="):
            found[int(folder[7:])] = {(f, os.stat(f"{root}/table/{folder}/{f}").st_mtime_ns) for f in os.listdir(f"{root}/table/{folder}") if f.startswith("part-")}
    return found


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_a_load_rewrites_only_its_buckets_and_equals_the_whole_upsert(spark, tmp_path):
    root = str(tmp_path)
    table = jobs_table(spark, root, 32)
    many = records(spark, [(f"k{i}", "a") for i in range(2000)])
    load_batch(table, many, "first")
    before, prior = files(root), table.read()
    old = content(prior)
    few = records(spark, [(f"k{i}", "b") for i in range(0, 20)] + [("new", "x"), (None, "n1"), (None, "n2"), ("k3", "c"), ("k3", "a")])
    touched = set(table.touched(upsert.stage(few)))
    assert 0 < len(touched) < 32
    staged, was = upsert.stage(few), spark.createDataFrame([list(r) for r in old], JOBS)
    actions = upsert.upsert_actions(staged, was)
    want = content(upsert.apply_changes(was, staged, actions))
    summary = load_batch(table, few, "second").first()
    after = files(root)
    assert {b for b in after if after[b] != before.get(b)} == touched
    assert content(table.read()) == want
    assert content(table.changes().filter(F.col("source_id") == "new").select("action")) == [("insert",)]
    assert (summary.inserted, summary.updated) == (2003, 22)
    # A replay writes nothing, and a scan of some buckets opens no other folder.
    load_batch(jobs_table(spark, root), few, "second")
    assert files(root) == after and jobs_table(spark, root).buckets == 32
    read = table.read(sorted(touched)[:2])
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in read.inputFiles()} >= set(sorted(touched)[:2])
    assert "PartitionFilters: [bucket" in read._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("dies_at", ["table", "changes", "batches"])
def test_a_load_lost_on_the_way_is_finished_by_its_replay(spark, tmp_path, monkeypatch, dies_at):
    root = str(tmp_path)
    table = jobs_table(spark, root, 8)
    load_batch(table, records(spark, [("a", "1"), ("b", "1")]), "one")
    two = records(spark, [("a", "2"), ("c", "2"), ("c", "3")])
    write = BucketTable._write

    def lost(self, rows, path, by, mode="overwrite"):
        if path.endswith(dies_at):
            raise OSError("lost")
        write(self, rows, path, by, mode)
        if dies_at == "batches" and path.endswith("changes"):
            raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(BucketTable, "_write", lost)
        with pytest.raises(OSError):
            load_batch(table, two, "two")
    assert table.unfinished("two") and not table.holds("two") and table.changes().count() == 2
    for _ in range(2):
        summary = load_batch(jobs_table(spark, root), two, "two").first()
    assert (summary.inserted, summary.updated, summary.skipped) == (3, 2, 0)
    assert sorted((r.source_id, r.job_title) for r in table.read().collect()) == [("a", "2"), ("b", "1"), ("c", "3")]


def test_a_load_lost_before_it_was_computed_starts_anew(spark, tmp_path, monkeypatch):
    table = jobs_table(spark, str(tmp_path), 4)
    with monkeypatch.context() as m:
        m.setattr(incremental.upsert, "apply_changes", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            load_batch(table, records(spark, [("a", "1")]), "one")
    assert table.read().count() == 0 and not table.unfinished("one")
    load_batch(table, records(spark, [("a", "2")]), "one")
    assert [r.job_title for r in table.read().collect()] == ["2"]


def test_a_bucket_that_loses_all_rows_is_empty(spark, tmp_path):
    table, quarantine = jobs_table(spark, f"{tmp_path}/jobs", 4), jobs_table(spark, f"{tmp_path}/low", 4)
    good = spark.createDataFrame([("a", "t", "c", LONG, "go, sql", "h", None)], JOBS)
    bad = spark.createDataFrame([(f"x{i}", None, None, "short", None, "h", None) for i in range(9)], JOBS)
    put_table(table, good.unionByName(bad), "all")
    for _ in range(2):
        report = label_table(table, quarantine, "profile")
    assert [r.source_id for r in table.read().collect()] == ["a"] and quarantine.read().count() == 9
    assert report.first().total_jobs == 10 if "total_jobs" in report.columns else report.count() == 1
    # They come back if a record brings them again.
    load_batch(table, spark.createDataFrame([("1", "x1", "t", "c", LONG)], SILVER), "again")
    assert sorted(r.source_id for r in table.read().collect()) == ["a", "x1"]


def test_empty_batches(spark, tmp_path):
    table = jobs_table(spark, str(tmp_path), 4)
    assert table.read().count() == 0 and table.changes().count() == 0
    summary = load_batch(table, records(spark, [("a", "1")]).limit(0), "none").first()
    assert (summary.total, table.read().count(), table.holds("none")) == (0, 0, True)
