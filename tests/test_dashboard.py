import sqlite3

import pytest

from hiremill.operators import dashboard

SCHEMA = "source_id string, job_title string, company string, description string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def tied(n_companies):
    """Company ``c{i}`` has jobs in falling number, with ties around the eighth place."""
    rows = []
    for i in range(n_companies):
        for j in range(max(1, 6 - i // 2)):
            rows.append((f"{i:02d}-{j}", f"title {j}", f"c{i:02d}", f"text {i}"))
    return [*rows, ("n", "nobody", None, "x"), ("e", None, "", None), ("s", "", "  ", "y")]


def test_company_counts_with_others(spark):
    got = [tuple(r) for r in dashboard.company_counts(frame(spark, tied(12))).collect()]
    assert [g[0] for g in got[:8]] == [f"c{i:02d}" for i in range(8)]
    assert [g[1] for g in got[:8]] == [6, 6, 5, 5, 4, 4, 3, 3]
    assert got[8] == ("Other (7 jobs, 5 employers)", 7, "other")


@pytest.mark.parametrize("n", [0, 3, 7])
def test_no_others_row_when_all_are_shown(spark, n):
    got = dashboard.company_counts(frame(spark, tied(n))).collect()
    assert len(got) == n + 1 and all(r.group is None for r in got)


def test_stats_of_nothing(spark):
    one = dashboard.dashboard_stats(frame(spark, [])).first()
    assert (one.total, one.companies, one.titles) == (0, [], [])


def test_stats_order(spark):
    one = dashboard.dashboard_stats(frame(spark, tied(12))).first()
    assert [c["count"] for c in one.companies] == [6, 6, 5, 5, 4, 4, 3, 3, 7]
    assert one.companies[-1]["group"] == "other" and one.titles[0]["label"] == "title 0"


def test_others_skip_null_company_but_not_empty(spark):
    rows = tied(12)
    found = {r.source_id for r in dashboard.other_companies(frame(spark, rows)).collect()}
    shown = {f"c{i:02d}" for i in range(8)}
    assert found == {r[0] for r in rows if r[2] is not None and r[2] not in shown}
    assert "e" in found and "n" not in found


def test_others_without_any_company_keep_every_row(spark):
    rows = [("1", "t", None, "d"), ("2", "t", "", "d")]
    assert dashboard.other_companies(frame(spark, rows)).count() == 2


def test_paging_has_no_gap_or_overlap(spark):
    df = frame(spark, tied(12))
    whole = dashboard.other_companies_page(df, limit=100).collect()
    pages = [r for o in range(0, 12, 4) for r in dashboard.other_companies_page(df, limit=4, offset=o).collect()]
    assert pages == whole


SEARCH = [
    ("1", "Data Engineer", "ACME", "x" * 300), ("2", "engineer", "acme", None), ("3", None, "Été", "50% remote"),
    ("4", "C++ dev", "a_b", "C:\\path"), ("5", "", None, None), ("6", "é", "ÉTÉ", "engIneer"), ("7", None, None, None),
]


@pytest.mark.parametrize("word", ["engineer", " ENGINEER ", "acme", "%", "_", "a_b", "\\", "é", "É", "", "zzz", "50%"])
def test_search_equals_sqlite(spark, word):
    con = sqlite3.connect(":memory:")
    con.execute("create table jobs (source_id, job_title, company, description)")
    con.executemany("insert into jobs values (?, ?, ?, ?)", SEARCH)
    p = f"%{word.strip()}%"
    want = con.execute(
        "select coalesce(job_title, ''), coalesce(company, ''), substr(coalesce(description, ''), 1, 200) from jobs "
        "where job_title like ? or company like ? or description like ? order by job_title, source_id",
        (p, p, p),
    ).fetchall()
    df = frame(spark, SEARCH)
    assert [tuple(r) for r in dashboard.search_jobs(df, word).collect()] == want
    one = dashboard.search_response(df, word, limit=2).first()
    assert ([tuple(r) for r in one.results], one.total, one.shown) == (want[:2], len(want), min(2, len(want)))


def test_other_keyword(spark):
    df = frame(spark, tied(12))
    assert dashboard.search_jobs(df, " OTHERS ").collect() == dashboard.other_companies_page(df).collect()
    assert dashboard.search_total(df, "other").first()[0] == 8
    assert dashboard.search_response(df, "Other").first().total == 8
