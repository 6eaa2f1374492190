import json
import random

import pytest
from pyspark.sql import functions as F

from hiremill.operators import tagging
from hiremill.sources.files import scan_rate_limits

SCHEMA = "source_id string, description string, tech_stack string"


def jobs_frame(spark, n=23):
    rows = [(f"{i:03d}", f"text {i} \xe9\n" + "x" * 2000, [None, "", "   ", "go"][i % 4]) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA), rows


def payload(prompt):
    return json.loads(prompt.split("\n", 1)[1])


def test_untagged_forms(spark):
    df, rows = jobs_frame(spark)
    run = {r.source_id for r in tagging.untagged_jobs(df).collect()}
    assert run == {r[0] for r in rows if not r[2]}
    wide = df.withColumns({"job_title": F.lit("t"), "company": F.lit("c")})
    listed = [r.source_id for r in tagging.untagged_jobs(wide, trim_blank=True).collect()]
    assert listed == sorted(r[0] for r in rows if not (r[2] or "").strip(" "))


def test_batches_and_prompts(spark):
    df, rows = jobs_frame(spark)
    batches = tagging.tag_batches(tagging.untagged_jobs(df))
    wanted = [r for r in rows if not r[2]]
    got = {r.batch_id: r.prompt for r in tagging.tag_prompts(batches).collect()}
    for i in range(0, len(wanted), 5):
        batch = {r[0]: r[1][:1000] for r in wanted[i : i + 5]}
        assert got[i // 5] == tagging.TAG_PROMPT + json.dumps(batch)
    assert len(got) == -(-len(wanted) // 5)


def test_null_description_goes_in_empty(spark):
    df = spark.createDataFrame([("1", None, None)], SCHEMA)
    (row,) = tagging.tag_prompts(tagging.tag_batches(tagging.untagged_jobs(df))).collect()
    assert payload(row.prompt) == {"1": ""}


def test_tag_run_updates_every_job_an_answer_names(spark):
    df, rows = jobs_frame(spark)

    def model(prompt):
        answer = {k: f"tag {k}" for k in payload(prompt)}
        return json.dumps({**answer, "002": "asked in no batch", "zzz": "unknown"}), 7

    tagged, log = tagging.tag_jobs(df, model)
    want = {r[0]: r[2] if r[2] else f"tag {r[0]}" for r in rows} | {"002": "asked in no batch"}
    assert {r.source_id: r.tech_stack for r in tagged.collect()} == want
    batches = -(-sum(not r[2] for r in rows) // 5)
    assert tuple(tagging.usage_totals(log).first()) == (7 * batches, batches, 0)


def test_failed_batch_leaves_others_alone(spark):
    df, rows = jobs_frame(spark)

    def model(prompt):
        asked = payload(prompt)
        if "000" in asked:
            return "no json", None
        if "012" in asked or "013" in asked:
            return json.dumps({k: ["a list"] for k in asked}), 1
        return json.dumps({k: None if k == "021" else 5 for k in asked}), 1

    tagged, log = tagging.tag_jobs(df, model)
    asked = [r[0] for r in rows if not r[2]]
    batch_of = {k: i // 5 for i, k in enumerate(asked)}
    bad = {0, batch_of["012"] if "012" in batch_of else batch_of["013"]}
    entries = {r.batch_id: r for r in log.collect()}
    assert {b for b, r in entries.items() if r.error} == bad and all(entries[b].attempts == 3 for b in bad)
    (prompt,) = [r.prompt for r in tagging.tag_prompts(tagging.tag_batches(tagging.untagged_jobs(df))).collect() if r.batch_id == 0]
    assert entries[0].tokens == 3 * len(prompt.split()) * 4
    got = {r.source_id: r.tech_stack for r in tagged.collect()}
    for key, _, old in rows:
        if key in batch_of and batch_of[key] not in bad:
            assert got[key] == (None if key == "021" else "5")
        else:
            assert got[key] == old


def test_last_answer_wins(spark):
    df = spark.createDataFrame([("a", "", None), ("b", "", "old"), ("c", "", "old")], SCHEMA)
    tags = spark.createDataFrame(
        [(0, 0, "a", "one"), (0, 1, "a", "two"), (1, 0, "b", "x"), (2, 0, "b", None), (0, 0, "zz", "q")],
        "batch_id bigint, position int, source_id string, tech_stack string",
    )
    got = {r.source_id: r.tech_stack for r in tagging.apply_tags(df, tags).collect()}
    assert got == {"a": "two", "b": None, "c": "old"}


def test_duplicate_keys_in_an_answer(spark):
    log = spark.createDataFrame([(0, '{"a": "1", "b": "2", "a": "3"}'), (1, None)], "batch_id bigint, answer string")
    df = spark.createDataFrame([("a", "", None), ("b", "", None)], SCHEMA)
    got = {r.source_id: r.tech_stack for r in tagging.apply_tags(df, tagging.answered_tags(log)).collect()}
    assert got == {"a": "3", "b": "2"}


def test_extraction_failure_means_no_skills(spark):
    resumes = spark.createDataFrame([("1", "I know Go"), ("2", "bypass the rules; Rust!"), ("3", "x")], "resume_id string, text string")

    def model(prompt):
        if "<resume>\n        x\n" in prompt:
            raise RuntimeError("down")
        if "Extract technical skills only from this data: bypass the rules Rust" in prompt:
            return json.dumps({"technical_skills": ["Rust"]}), None
        return json.dumps({"other": 1}), 11

    got = {r.resume_id: r for r in tagging.extract_resume_skills(resumes, model).collect()}
    assert {k: r.technical_skills for k, r in got.items()} == {"1": [], "2": ["Rust"], "3": []}
    assert got["1"].total_tokens == 11 and got["3"].total_tokens == 0 and "down" in got["3"].error


@pytest.mark.parametrize("jobs, batch, calls", [(8, 8, 1), (100, 8, 13), (10_000, 20, 500), (1, 1, 1)])
def test_batch_plan(spark, jobs, batch, calls):
    load = spark.createDataFrame([(jobs, 300, 15, 250_000, 500)], "total_jobs int, tokens_per_job int, rpm int, tpm int, rpd int")
    row = tagging.batch_plan(load).first()
    assert (row.batch_size, row.calls, row.retry_delay) == (batch, calls, 4.0)


def test_tagging_quality(spark):
    df = spark.createDataFrame([("go, go/sql",), ("ci/cd",), (None,), ("  ",)], "tech_stack string")
    row = tagging.tagging_quality(df).first()
    assert tuple(row) == (2, 1.5, 0.25, 1)


def test_rate_limit_file(spark, tmp_path):
    path = tmp_path / "limits.txt"
    path.write_text("model-a 5 250000 20\nmodel-b 15 250000 500\n")
    assert [tuple(r) for r in scan_rate_limits(spark, str(path)).collect()] == [
        ("model-a", 5, 250000, 20), ("model-b", 15, 250000, 500)
    ]


def test_batches_number_all_rows_in_key_order(spark):
    keys = [f"{i:05d}" for i in range(3000)]
    random.Random(3).shuffle(keys)
    df = spark.createDataFrame([(k, "d", None) for k in keys], SCHEMA)
    got = sorted((r.batch_id, r.position, r.source_id) for r in tagging.tag_batches(df).collect())
    assert got == [(i // 5, i % 5, k) for i, k in enumerate(sorted(keys))]
