"""Search over the index of trigrams and pages of a table in order, against the scan and the sort."""

import random

import pytest
from pyspark.sql import functions as F

from hiremill.operators import dashboard, paging, search
from hiremill.schemas import JOBS, conform
from tests.test_maintained import scanned_rows

WORDS = ["Spark", "sPARK", "data lake", "Étion", "étion", "a", "", "C++", "ſtate", "\U0001F600 ok", "50% off", "x_y", "line\nbreak"]


def jobs_of(spark, rows):
    return conform(spark.createDataFrame(rows, "source_id string, job_title string, company string, description string"), JOBS)


@pytest.fixture(scope="module")
def jobs(spark):
    rng = random.Random(4)
    text = lambda n: rng.choice([None, " ".join(rng.choices(WORDS, k=n))])
    rows = [(str(i % 280) if i % 29 else None, text(2), text(1), text(9)) for i in range(300)]
    return jobs_of(spark, rows).cache()


@pytest.fixture(scope="module")
def index(spark, jobs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "made")
    search.write_index(jobs, path, buckets=4, files=3)
    return path


def listed(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize(
    "asked", ["spark", "SPARK dat", " data%Étion ", "ÉTION", "étion", "sp_rk", "p%rk", "ab", "", "  ", "%%", "no such words", "\U0001F600 o", "c++ ", "50% off", "e\nb", "other", "state"]
)
def test_rows_are_those_of_the_scan(spark, jobs, index, asked):
    found = search.candidates(spark, index, asked)
    want, got = dashboard.matching_jobs(jobs, asked), dashboard.matching_jobs(found.select(*jobs.columns), asked)
    assert listed(got) == listed(want)
    assert dashboard.search_total(found, asked).collect() == dashboard.search_total(jobs, asked).collect()


def test_trigrams(spark):
    texts = [None, "", "ab", "abc", "ABCabc", "a\U0001F600bc", "ÀBC"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(search.trigrams("t")).collect()] == [[], [], [], ["abc"], ["abc", "bca", "cab"], ["a\U0001F600b", "\U0001F600bc"], ["Àbc"]]
    assert search.pattern_trigrams(" SPA_k%lake ") == ["ake", "lak", "spa"]
    long = spark.range(1).select(F.repeat(F.lit("abcdefg "), 200_000).alias("t"))
    assert long.select(F.size(search.trigrams("t"))).first()[0] == 8


def test_a_search_reads_a_part_of_the_index(spark, tmp_path):
    text = F.concat_ws(" ", *[F.substring(F.sha2((F.col("id") * 10 + i).cast("string"), 256), 1, 12) for i in range(10)])
    wide = spark.range(5_000).select(F.format_string("%08d", "id").alias("source_id"), text.alias("job_title"), F.lit("the same").alias("company"), F.lit("of all").alias("description"))
    rare = wide.withColumn("description", F.when(F.col("source_id") == "00004321", "quiet zebra").otherwise("of all"))
    search.write_index(rare, f"{tmp_path}/i", buckets=64)
    postings, n = search.rarest_postings(spark, f"{tmp_path}/i", search.pattern_trigrams("the same%ZEBRA"))
    everything = search._postings(spark, f"{tmp_path}/i").count()
    rows, read = scanned_rows(spark, postings)
    assert n == search.RAREST and len(rows) <= 3 + 5_000 and read < everything / 8
    got = search.candidates(spark, f"{tmp_path}/i", "quiet ZEBRA").collect()
    assert [r.source_id for r in got] == ["00004321"]


def test_empty_index_and_empty_pages(spark, tmp_path):
    none = jobs_of(spark, [])
    search.write_index(none, f"{tmp_path}/i")
    assert search.candidates(spark, f"{tmp_path}/i", "spark").count() == 0 and search.candidates(spark, f"{tmp_path}/i", "").count() == 0
    paging.write_pages(none, f"{tmp_path}/p", ["company", "source_id"])
    for page in (paging.page_at(spark, f"{tmp_path}/p", 0, 5), paging.page_after(spark, f"{tmp_path}/p", ["company", "source_id"], None, 5)):
        assert page.count() == 0 and page.columns == [*none.columns, "place"]


ORDER = ["company", "job_title", "source_id"]


def test_pages_by_position_and_by_key(spark, jobs, tmp_path):
    path = f"{tmp_path}/p"
    paging.write_pages(jobs, path, ORDER, parts=7)
    names = [*ORDER, "description"]
    want = [tuple(r) for r in jobs.orderBy(*[F.asc_nulls_first(c) for c in ORDER]).select(*ORDER).collect()]
    for offset, limit in ((0, 10), (95, 30), (290, 30), (299, 1), (300, 5), (0, 300), (41, 1)):
        got = paging.page_at(spark, path, offset, limit).select(*ORDER).collect()
        assert [tuple(r) for r in got] == want[offset : offset + limit]
    shown, seen, whole = None, [], []
    while page := paging.page_after(spark, path, ORDER, shown, 37).collect():
        shown = page[-1]
        seen += [tuple(r[c] for c in ORDER) for r in page]
        whole += [tuple(r[c] for c in names) for r in page]
    assert seen == want and sorted(whole, key=repr) == sorted(map(tuple, jobs.select(*names).collect()), key=repr)


def test_a_late_page_reads_few_files(spark, tmp_path):
    rows = spark.range(20_000).select(F.format_string("%05d", F.col("id") * 7919 % 20_000).alias("source_id"))
    path = f"{tmp_path}/p"
    paging.write_pages(rows, path, ["source_id"], parts=50)
    for page in (paging.page_at(spark, path, 15_000, 20), paging.page_after(spark, path, ["source_id"], rows.selectExpr("'14999' source_id", "cast(1L << 40 as bigint) place").first(), 20)):
        got, read = scanned_rows(spark, page)
        assert [r.source_id for r in got] == [f"{i:05d}" for i in range(15_000, 15_020)] and read <= 2_000
