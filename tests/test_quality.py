from hiremill.operators import quality
from hiremill.schemas import JOBS

GOOD = "d" * 150


def jobs(spark, rows):
    return spark.createDataFrame([(*r, "python", "h", None) for r in rows], JOBS)


ROWS = [
    ("1", "t", "c", GOOD),
    ("2", "u", "c", "e" * 301),
    ("3", "v", "c", "short"),
    ("4", "", "c", GOOD),
    ("5", "w", None, GOOD),
    ("6", "x", "c", None),
    ("7", "y", "c", GOOD),
]


def test_split_covers_all_rows_once(spark):
    labelled = quality.label_jobs(jobs(spark, ROWS))
    high = {r.source_id for r in quality.high_quality(labelled).collect()}
    low = {r.source_id for r in quality.low_quality(labelled).collect()}
    assert (high, low) == ({"1", "2", "7"}, {"3", "4", "5", "6"})
    assert tuple(quality.quality_counts(labelled).first()) == (3, 4)


def test_report(spark):
    report = quality.quality_report(quality.label_jobs(jobs(spark, ROWS))).first().asDict()
    assert report == {
        "total_records": 3, "quarantined": 4, "null_job_title": 0, "null_company": 0, "null_description": 0,
        "avg_description_length": 200, "shortest_length": 150, "shortest_source_id": "1", "shortest_job_title": "t",
        "longest_length": 301, "longest_source_id": "2", "longest_job_title": "u",
    }


def test_report_of_nothing(spark):
    report = quality.quality_report(quality.label_jobs(jobs(spark, []))).first()
    assert tuple(report) == (0, 0, 0, 0, 0, 0, 0, "N/A", "N/A", 0, "N/A", "N/A")


def test_single_statistics(spark):
    df = jobs(spark, [*ROWS, ("0", "z", "c", "")])
    assert tuple(quality.missing_counts(df).first()) == (1, 1, 2)
    assert tuple(quality.shortest_description(df).first()) == (0, "0", "z")
    assert tuple(quality.longest_description(df).first()) == (301, "2", "u")
    assert quality.mean_description_length(df).first()[0] == (150 * 4 + 301 + 5) // 7
    assert quality.mean_description_length(df.limit(0)).first()[0] == 0
    assert quality.shortest_description(df.limit(0)).collect() == []
