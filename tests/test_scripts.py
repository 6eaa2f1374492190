import pytest

from hiremill.schemas import JOBS
from hiremill.sources import scripts


@pytest.fixture
def tables(spark):
    rows = [
        ("1", "t", "c", "long", "go", "h1", "HIGH"), ("2", None, "", "", "  ", None, "LOW"), ("3", "u", "c", None, None, "h3", None),
    ]
    return {"jobs": spark.createDataFrame(rows, JOBS), "jobs_quarantine": spark.createDataFrame([], JOBS)}


def rows(tables, name, *params):
    return [tuple(r) for r in scripts.run_script(tables, name, *params).rows.collect()]


def test_queries(tables):
    assert rows(tables, "count_jobs.sql") == [(3,)]
    assert rows(tables, "count_quarantined") == [(0,)]
    assert [rows(tables, f"count_null_{c}") for c in ("job_title", "company", "description")] == [[(1,)], [(1,)], [(2,)]]
    assert rows(tables, "avg_description_length") == [(2.0,)]
    assert rows(tables, "shortest_description") == [(0, "2", None)]
    assert rows(tables, "longest_description") == [(4, "1", "t")]
    assert rows(tables, "select_content_hash", "3") == [("h3",)]
    assert rows(tables, "select_all_tech_stacks") == [("go",)]
    assert [r[0] for r in rows(tables, "select_untagged_jobs")] == ["2", "3"]
    assert len(rows(tables, "select_all_jobs")[0]) == 6
    assert rows(tables, "table_info_jobs")[0] == ("source_id", "string")


def test_changes(tables):
    done = scripts.run_script(tables, "quarantine_low_quality")
    assert (done.rows_affected, rows(done.tables, "count_quarantined")) == (1, [(1,)])
    done = scripts.run_script(done.tables, "delete_low_quality")
    assert (done.rows_affected, rows(done.tables, "count_jobs")) == (1, [(2,)])
    done = scripts.run_script(done.tables, "clear_jobs_quarantine")
    assert (done.rows_affected, rows(done.tables, "count_quarantined")) == (1, [(0,)])
    done = scripts.run_script(tables, "insert_job", "4", "n", "c", "d", None, "h4")
    assert (done.rows_affected, rows(done.tables, "select_content_hash", "4")) == (1, [("h4",)])
    again = scripts.run_script(done.tables, "insert_job", "4", "n", "c", "d", None, "other")
    assert (again.rows_affected, rows(again.tables, "select_content_hash", "4")) == (0, [("h4",)])
    done = scripts.run_script(tables, "update_job", "T", "C", "D", None, "new", "1")
    assert done.rows_affected == 1 and rows(done.tables, "select_all_jobs")[0] == ("1", "T", "C", "D", None, "new")
    assert scripts.run_script(tables, "update_tech_stack", "x", "none").rows_affected == 0
    assert scripts.run_script(tables, "update_quality", "LOW", "3").tables["jobs"].filter("quality = 'LOW'").count() == 2
    assert scripts.run_script(tables, "clear_tech_stack").rows_affected == 3
    assert scripts.run_script(tables, "add_quality_column").rows_affected == 0


def test_failures_are_reported(tables):
    assert "no statement" in scripts.run_script(tables, "drop_everything").error
    assert scripts.run_script(tables, "select_content_hash").error
    assert scripts.run_script({}, "count_jobs").error
