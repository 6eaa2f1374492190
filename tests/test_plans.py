"""What the plans must and must not contain."""

import re

import pytest

from hiremill.operators import dashboard, gaps, tagging, upsert
from hiremill.plans import fixtures
from hiremill.schemas import CHANGES, JOBS, SILVER
from tests.check_oracles import entry_points

SF = "/root/testdata/sf0.001"


def plan(df, run=False):
    if run:
        df.write.format("noop").mode("overwrite").save()
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().replace("\0", "")
    return text.split("== Initial Plan ==")[0] if run else text


# Streams have run by the time their query returns.
@pytest.mark.parametrize("name", [n for n in entry_points.queries() if not n.endswith("_stream")])
def test_no_cross_join_and_no_sort_of_rows_in_one_task(spark, name):
    text = plan(entry_points.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    for single in re.finditer(r"Window \[.*?\].*\n(.*\n){1,3}?.*Exchange SinglePartition", text):
        # The only window over one partition adds up row counts per chunk.
        assert "_rows" in single.group(0)


def scanned(text):
    return set(re.findall(r"ReadSchema: struct<([^>]*)>", text))


def test_scans_read_only_the_columns_used(spark):
    p = fixtures.postings(spark, SF)
    assert scanned(plan(dashboard.title_counts(p))) == {"p_partkey:bigint,p_name:string"}
    assert scanned(plan(tagging.clear_tags(p).select("source_id"))) == {"p_partkey:bigint"}
    demand = plan(gaps.skill_demand(p))
    assert scanned(demand) == {"p_partkey:bigint,p_name:string,p_brand:string,p_type:string"}
    assert "partial_count" in demand


def test_pages_are_top_k(spark):
    for df in (dashboard.search_jobs, lambda p, _: dashboard.other_companies_page(p)):
        text = plan(df(fixtures.postings(spark, SF), "ring"))
        assert "TakeOrderedAndProject" in text and "Exchange range" not in text
    others = plan(dashboard.other_companies_page(fixtures.postings(spark, SF)))
    assert "LeftAnti, BuildRight" in others


def test_company_groups_are_computed_once(spark):
    text = plan(dashboard.company_counts(fixtures.postings(spark, SF)), run=True)
    assert text.count("FileScan") == 1 and text.count("ReusedExchange") >= 1


def test_decoders_do_not_shuffle(spark, tmp_path):
    from hiremill.operators import decode

    pages = spark.createDataFrame([("1", "<p>x</p>")], "doc_key string, html string")
    assert "Exchange" not in plan(decode.extract_listings(pages))


def test_small_load_leaves_the_table_unshuffled(spark, tmp_path):
    table, load = str(tmp_path / "jobs"), str(tmp_path / "load")
    spark.createDataFrame([(str(i), "t", "c", "d", None, "h", None) for i in range(50)], JOBS).write.parquet(table)
    rows = [("1", "7", "t", "c", "new")]
    spark.createDataFrame(rows, SILVER).write.parquet(load)
    prior, staged = spark.read.parquet(table), upsert.stage(spark.read.parquet(load))
    spark.createDataFrame([("1", "7", "h2", "update")], CHANGES).write.parquet(str(tmp_path / "changes"))
    actions = spark.read.parquet(str(tmp_path / "changes"))
    kept = plan(upsert.apply_changes(prior, staged, actions), run=True).split("Union")[1]
    first_branch = kept[: kept.index("FileScan")]
    assert "BroadcastHashJoin [source_id" in first_branch and "LeftAnti" in first_branch
    assert "Exchange hashpartitioning" not in first_branch.split("BroadcastQueryStage")[0]


def test_hot_key_shuffle_runs_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staged = upsert.stage(fixtures.event_changes(spark, SF))
        text = plan(upsert.upsert_actions(staged, fixtures.prior_jobs(spark, SF), hot_rows=20), run=True)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Keys are chunked in one exchange that both windows read.
    assert re.search(r"ReusedExchange \[_key#\d+, _turn", text)
