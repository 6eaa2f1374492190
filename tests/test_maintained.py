"""Measures kept by changes, incremental ingest, and lookups by key, against the whole computation."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from hiremill.functions.skills import parse_skills
from hiremill.operators import maintained
from hiremill.plans import incremental
from hiremill.plans.incremental import bronze_table, ingest_archives, ingest_folder, jobs_table, load_batch, measures_table, put_table
from hiremill.schemas import JOBS, SILVER
from hiremill.sources.buckets import BucketTable
from hiremill.sources.keyed import lookup, write_keyed


def whole(table):
    """The same measures from all jobs."""
    jobs = table.read()
    own = {(r.kind, r["name"]): (r.n, r.total) for r in maintained.measures(jobs.withColumn("sign", F.lit(1))).collect()}
    return own, jobs.agg(F.min(F.length("description")).alias("m")).first().m


def kept_rows(kept):
    rows = {(r.kind, r["name"]): (r.n, r.total) for r in kept.read().collect()}
    return {k: v for k, v in rows.items() if k[0] != "shortest"}


def loads(spark, seed=4):
    rng = random.Random(seed)
    for turn in range(4):
        rows = [(f"{turn}{i:03d}", rng.choice(["a", "b", "c", "d", "e", None]), "t", rng.choice(["x", "y", "", None]), rng.choice([None, "d" * rng.randrange(1, 90)])) for i in range(12)]
        yield f"load-{turn}", spark.createDataFrame(rows, SILVER)


def tables(spark, root):
    return jobs_table(spark, f"{root}/jobs", 5), measures_table(spark, f"{root}/kept", 3)


def test_measures_equal_the_whole_computation_after_every_batch(spark, tmp_path):
    table, kept = tables(spark, tmp_path)
    for name, records in loads(spark):
        load_batch(table, records, name, kept)
        own, shortest = whole(table)
        assert kept_rows(kept) == {k: v for k, v in own.items() if v != (0, 0)}
        assert maintained.overview(kept.read()).first().shortest == shortest
    before = kept_rows(kept)
    load_batch(table, records, name, kept)
    assert kept_rows(kept) == before
    top = [(r["name"], r.n) for r in maintained.top_of(kept.read(), "company", 1).collect()]
    assert top == sorted(((k[1], n) for k, (n, _) in own.items() if k[0] == "company"), key=lambda x: (-x[1], x[0]))[:1]


@pytest.mark.parametrize("lost", ["jobs", "kept"])
def test_measures_survive_a_load_lost_between_the_tables(spark, tmp_path, monkeypatch, lost):
    table, kept = tables(spark, tmp_path)
    (first, one), (second, two), *_ = loads(spark)
    load_batch(table, one, first, kept)
    publish = BucketTable.publish

    def dies(self, batch):
        if batch == second and self.root.endswith(lost):
            raise OSError("lost")
        publish(self, batch)

    with monkeypatch.context() as m:
        m.setattr(BucketTable, "publish", dies)
        with pytest.raises(OSError):
            load_batch(table, two, second, kept)
    load_batch(table, two, second, kept)
    assert kept_rows(kept) == {k: v for k, v in whole(table)[0].items() if v != (0, 0)}


def test_skills_go_when_a_job_changes(spark, tmp_path):
    table, kept = tables(spark, tmp_path)
    rows = spark.createDataFrame([("a", "t", "x", "d", "go, SQL", "old", None), ("b", "t", "x", "d", "sql", "old", None)], JOBS)
    put_table(table, rows, "prior")
    own = maintained.measures(rows.withColumn("sign", F.lit(1)))
    kept.replace("prior", list(range(kept.buckets)), own, spark.createDataFrame([], incremental.CHANGES))
    assert {r.skill: r.demand for r in maintained.counts_of(kept.read(), "skill", "skill", "demand").collect()} == {"go": 1, "sql": 2}
    load_batch(table, spark.createDataFrame([("1", "a", "t", "x", "new")], SILVER), "load", kept)
    assert {r.skill: r.demand for r in maintained.counts_of(kept.read(), "skill", "skill", "demand").collect()} == {"sql": 1}
    assert table.read().select(F.explode(parse_skills("tech_stack"))).count() == 1


def archive(text):
    return f'MIME-Version: 1.0\r\nContent-Type: multipart/related; boundary="e"\r\n\r\n--e\r\nContent-Type: text/html; charset="utf-8"\r\n\r\n<p>{text}</p>\r\n--e--\r\n'.encode()


def test_only_new_and_rewritten_files_are_ingested(spark, tmp_path, monkeypatch):
    folder, table = tmp_path / "pages", bronze_table(spark, f"{tmp_path}/bronze", 8)
    folder.mkdir()

    def put(name, text, at):
        (folder / f"{name}.mhtml").write_bytes(archive(text))
        os.utime(folder / f"{name}.mhtml", (at, at))

    now = int(time.time()) - 1000
    for i in range(6):
        put(f"f{i}", f"one {i}", now)
    decoded, real = [], incremental.decode.decode_mhtml
    monkeypatch.setattr(incremental.decode, "decode_mhtml", lambda df: decoded.append(sorted(r.doc_key for r in df.select("doc_key").collect())) or real(df))
    assert ingest_folder(table, str(folder), "1") == 6 and ingest_folder(table, str(folder), "2") == 0
    put("f2", "two 2", now + 10)
    put("new", "two", now)  # as old as the newest one, but not held
    assert ingest_folder(table, str(folder), "3") == 2 and ingest_folder(table, str(folder), "4") == 0
    assert decoded == [[f"f{i}" for i in range(6)], ["f2", "new"]]
    html = {r.doc_key: r.html for r in table.read().collect()}
    assert html.keys() == {*(f"f{i}" for i in range(6)), "new"} and "two 2" in html["f2"] and "one 3" in html["f3"]
    ingest_archives(table, spark.createDataFrame([("f0", b"broken", None)], "doc_key string, content binary, modified timestamp"), "5")
    rows = {r.doc_key: r for r in table.read().collect()}
    assert len(rows) == 7 and rows["f0"].error_kind and rows["f0"].html is None


def scanned_rows(spark, df):
    """Rows that left the file scan when ``df`` ran."""
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    return rows, plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def test_a_lookup_reads_few_row_groups(spark, tmp_path):
    path = str(tmp_path / "keyed")
    wide = spark.range(40_000).select(F.sha2(F.col("id").cast("string"), 256).alias("source_id"), F.sha2(F.concat(F.lit("h"), F.col("id").cast("string")), 256).alias("content_hash"))
    write_keyed(wide, path, "source_id", files=8, group_bytes=64 << 10)
    keys = wide.filter("content_hash < '0004'").unionByName(wide.limit(0)).select("source_id")
    asked = keys.unionByName(spark.createDataFrame([("absent",), (None,)], "source_id string"))
    n = keys.count()
    rows, scanned = scanned_rows(spark, lookup(spark, path, asked, "source_id"))
    assert 0 < n <= 10 and len(rows) == n and scanned < 40_000 / 4
    assert lookup(spark, path, wide.select("source_id"), "source_id", most_keys=100).count() == 40_000
    assert lookup(spark, path, asked.limit(0), "source_id").count() == 0
    with pytest.raises(FileNotFoundError):
        lookup(spark, f"{path}-none", asked, "source_id")
