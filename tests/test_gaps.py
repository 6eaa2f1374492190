import random
from collections import Counter

import pytest

from hiremill.functions.labels import NO_GAPS
from hiremill.operators import gaps, ordering, runs
from hiremill.plans.analysis import find_skill_gaps, reply_to_messages
from tests.test_text import parse


def make_jobs(spark, stacks):
    return spark.createDataFrame([(str(i), s) for i, s in enumerate(stacks)], "source_id string, tech_stack string")


def make_sets(spark, sets):
    return spark.createDataFrame(list(sets.items()), "resume_id string, skills array<string>")


def random_market(seed):
    rng = random.Random(seed)
    words = [f"s{i}" for i in range(60)] + ["ci/cd", "a/b testing", "C/C++"]
    stacks = [", ".join(rng.choices(words, k=rng.randint(0, 6))) for _ in range(200)] + [None, "", "  "]
    demand = Counter(s for stack in stacks for s in parse(stack))
    sets = {f"r{i}": rng.sample(sorted(demand), rng.randint(0, len(demand))) + ["unknown"] for i in range(25)}
    sets["all"], sets["none"] = sorted(demand), []
    return stacks, demand, sets


@pytest.mark.parametrize("piece_rows", [7, 20_000])
def test_gaps_equal_brute_force(spark, piece_rows):
    stacks, demand, sets = random_market(1)
    d = gaps.skill_demand(make_jobs(spark, stacks))
    assert {r.skill: r.demand for r in d.collect()} == demand
    rows = gaps.gap_rows(d, make_sets(spark, sets), piece_rows=piece_rows).collect()
    want = {(r, s, n) for r, have in sets.items() for s, n in demand.items() if s not in have}
    assert len(rows) == len(want) and {tuple(r) for r in rows} == want


@pytest.mark.parametrize("n", [1, 5])
def test_top_gaps_equal_brute_force(spark, n):
    stacks, demand, sets = random_market(2)
    d = gaps.skill_demand(make_jobs(spark, stacks))
    got = {r.resume_id: [tuple(t) for t in r.top] for r in gaps.top_gaps(d, make_sets(spark, sets), n).collect()}
    ranked = sorted(demand.items(), key=lambda kv: (-kv[1], kv[0]))
    assert got == {r: [kv for kv in ranked if kv[0] not in have][:n] for r, have in sets.items()}


def test_reports(spark):
    stacks, demand, sets = random_market(3)
    d = gaps.skill_demand(make_jobs(spark, stacks))
    for r in gaps.gap_reports(d, make_sets(spark, sets)).collect():
        lacking = {s: n for s, n in demand.items() if s not in sets[r.resume_id]}
        assert r.gaps == sorted(lacking)
        ranked = sorted(lacking.items(), key=lambda kv: (-kv[1], kv[0]))
        assert [tuple(s) for s in r.demand_statistics] == ranked
    summaries = {r.resume_id: tuple(r)[1:] for r in gaps.demand_summaries(d, make_sets(spark, sets)).collect()}
    for key, have in sets.items():
        lacking = [n for s, n in demand.items() if s not in have]
        assert summaries[key] == (len(demand), len(have), len(lacking), min(lacking, default=None), max(lacking, default=None))


def test_report_text(spark):
    jobs = make_jobs(spark, ["it's, b" + "x" * 20, "it's", None])
    d = gaps.skill_demand(jobs)
    sets = make_sets(spark, {"some": [], "all": ["it's", "b" + "x" * 20]})
    usage = spark.createDataFrame([("some", 12, 2.5)], "resume_id string, total_tokens bigint, time_ms double")
    replies = {r.resume_id: r.reply for r in gaps.report_text(gaps.gap_reports(d, sets, usage)).collect()}
    name, quoted = "b" + "x" * 20, "it's"
    assert replies == {
        "all": NO_GAPS,
        "some": f"gaps={sorted([name, quoted])} time={2.5:.0f} tokens=12\n\n"
        "--- BONUS: Top 5 Most In-Demand Missing Skills ---\n"
        f"Skill: {quoted:<20} | Missing from resume, but required by 2 job(s)\n"
        f"Skill: {name} | Missing from resume, but required by 1 job(s)",
    }


def test_one_resume(spark):
    d = gaps.skill_demand(make_jobs(spark, ["C/C++, go", "go, sql", "sql, rust"]))
    has = spark.createDataFrame([("c",), ("c++",), ("c/c++",)], "skill string")
    assert [tuple(r) for r in gaps.top_missing(d, has).collect()] == [("go", 2), ("sql", 2), ("rust", 1)]
    assert tuple(gaps.demand_summary(d, has).first()) == (5, 3, 3, 1, 2)


def test_analysis_is_repeatable_and_needs_no_tags(spark):
    resumes = spark.createDataFrame([("a", "Go, SQL\nnothing else"), ("b", "")], "resume_id string, text string")
    jobs = make_jobs(spark, ["go, rust", "Rust/SQL", None])
    first, second = find_skill_gaps(resumes, jobs), find_skill_gaps(resumes, jobs)
    assert {r.resume_id: r.gaps for r in first.collect()} == {"a": ["rust"], "b": ["go", "rust", "sql"]}
    assert all(r.gaps_identical for r in runs.compare_runs(first, second).collect())
    nothing = find_skill_gaps(resumes, make_jobs(spark, [None])).collect()
    assert [(r.gaps, r.demand_statistics) for r in nothing] == [([], []), ([], [])]


def test_compare_runs(spark):
    schema = "resume_id string, gaps array<string>, total_tokens bigint, time_ms double"
    a = spark.createDataFrame([("1", ["x"], 200, 10.0), ("2", ["y"], 0, 1.0), ("3", [], 1, 1.0)], schema)
    b = spark.createDataFrame([("1", ["x"], 150, 12.0), ("2", ["z"], 5, 1.0), ("4", [], 1, 1.0)], schema)
    got = {r.resume_id: tuple(r)[1:] for r in runs.compare_runs(a, b).collect()}
    assert got == {"1": (True, 25.0, -20.0), "2": (False, None, 0.0), "3": (False, None, None), "4": (False, None, None)}
    left = spark.createDataFrame([("k", 1), ("k", 1), ("m", 2)], "k string, v int")
    right = spark.createDataFrame([(1, "k"), (3, "n")], "v int, k string")
    assert {tuple(r) for r in runs.differing_rows(left, right).collect()} == {("k", 1, "first"), ("m", 2, "first"), ("n", 3, "second")}


def test_replies(spark):
    rows = [("g", " ", None), ("c", "hi", ""), ("q", "who?", "cv"), ("s", "Analyze", "go"), ("e", "boom", "")]
    messages = spark.createDataFrame(rows, "message_id string, message string, pdf_text string")

    def model(prompt):
        if prompt == "boom":
            raise RuntimeError("down")
        return "" if prompt == "hi" else f" <{prompt[:11]}> "

    replies = {r.message_id: r.reply for r in reply_to_messages(messages, make_jobs(spark, ["go"]), model).collect()}
    assert replies == {
        "g": "Send a message to chat, or upload a resume PDF.", "c": "I could not generate a reply right now.",
        "q": "<Resume text>", "s": NO_GAPS, "e": "[Chat model error] down",
    }


@pytest.mark.parametrize("n, chunks", [(0, 4), (1, 4), (1000, 1), (1000, 16), (5000, 100)])
def test_number_rows(spark, n, chunks):
    keys = [f"{i:04d}" for i in range(n)]
    random.Random(n).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(7)
    got = {r.k: r.row_index for r in ordering.number_rows(df, "k", chunks=chunks).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}
