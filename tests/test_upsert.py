import hashlib
import random

import pytest

from hiremill.operators import upsert
from hiremill.schemas import JOBS

RECORD = "doc_key string, source_id string, job_title string, company string, description string"


def sha(*parts):
    return hashlib.sha256("|".join(str(p) for p in parts).encode()).hexdigest()


def fold(records, prior):
    """The load, one record at a time."""
    table = {r[0]: list(r) for r in prior if r[0] is not None}
    unkeyed = [tuple(r) for r in prior if r[0] is None]
    actions = {}
    for doc_key, source_id, *content in sorted(records):
        digest = sha(*content)
        if source_id is None:
            unkeyed.append((None, *content, None, digest, None))
            actions[doc_key] = "insert"
        elif source_id not in table:
            table[source_id] = [source_id, *content, None, digest, None]
            actions[doc_key] = "insert"
        elif table[source_id][5] != digest:
            table[source_id] = [source_id, *content, None, digest, table[source_id][6]]
            actions[doc_key] = "update"
        else:
            actions[doc_key] = "skip"
    return actions, sorted([tuple(r) for r in table.values()] + unkeyed, key=repr)


def check(spark, records, prior, hot_rows):
    staged = upsert.stage(spark.createDataFrame(records, RECORD))
    before = spark.createDataFrame(prior, JOBS)
    actions = upsert.upsert_actions(staged, before, hot_rows=hot_rows)
    want_actions, want_table = fold(records, prior)
    assert {r.doc_key: r.action for r in actions.collect()} == want_actions
    after = upsert.apply_changes(before, staged, actions)
    got = sorted([tuple(r) for r in after.collect()], key=repr)
    assert got == want_table
    keys = [r[0] for r in got if r[0] is not None]
    assert len(keys) == len(set(keys))
    counts = tuple(upsert.load_summary(spark.createDataFrame(records, RECORD), actions).first())
    kinds = list(want_actions.values())
    assert counts == (len(kinds), kinds.count("insert"), kinds.count("update"), kinds.count("skip"))


@pytest.mark.parametrize("hot_rows", [1_000_000, 20])
def test_equals_the_sequential_load(spark, hot_rows):
    rng = random.Random(hot_rows)
    # A third of all records fall on one key.
    keys = ["hot"] * 300 + [f"k{i % 40}" for i in range(550)] + [None] * 20 + [""] * 30
    rng.shuffle(keys)
    records = [
        (f"{i:06d}", k, rng.choice("ab"), rng.choice(["c", None]), rng.choice(["d", "e"])) for i, k in enumerate(keys)
    ]
    prior = [
        (f"k{i}", "a", "c", "d", "python", None if i % 7 == 0 else sha("a", "c", "d"), "HIGH") for i in range(0, 60, 2)
    ] + [(None, "a", "c", "d", "go", sha("a", "c", "d"), "LOW")]
    check(spark, records, prior, hot_rows)


def test_hot_key_is_cut_into_chunks(spark):
    records = [(f"{i:06d}", "hot", "t", "c", "d") for i in range(900)]
    staged = upsert.stage(spark.createDataFrame(records, RECORD))
    (row,) = upsert._hot_key_cuts(staged, 50).collect()
    assert 5 <= len(row.cuts.cuts) <= 60 and row.cuts.cuts == sorted(row.cuts.cuts)


@pytest.mark.parametrize("hot_rows", [1_000_000, 1])
def test_back_and_forth_in_one_load(spark, hot_rows):
    a, b = ("t", "c", "one"), ("t", "c", "two")
    check(spark, [("1", "k", *a), ("2", "k", *b), ("3", "k", *a)], [], hot_rows)


def test_prior_without_hash_is_updated(spark):
    check(spark, [("1", "k", "t", "c", "d")], [("k", "t", "c", "d", "go", None, "HIGH")], 100)


def test_separator_collision_keeps_the_older_text(spark):
    records = [("1", "k", "a|b", "c", "d"), ("2", "k", "a", "b|c", "d")]
    check(spark, records, [], 100)


def test_same_load_again_only_skips(spark):
    records = [(f"{i:03d}", f"k{i % 9}", "t", "c", "d") for i in range(40)]
    staged = upsert.stage(spark.createDataFrame(records, RECORD))
    empty = spark.createDataFrame([], JOBS)
    first = upsert.apply_changes(empty, staged, upsert.upsert_actions(staged, empty))
    again = upsert.upsert_actions(staged, first)
    assert {r.action for r in again.collect()} == {"skip"}


def test_empty_load(spark):
    check(spark, [], [("k", "t", "c", "d", "go", sha("t", "c", "d"), None)], 100)


def test_unreadable_records_count_as_skipped(spark):
    from hiremill.sources.files import parse_records

    texts = [
        ("1", '{"source_id": "k", "job_title": null, "company": "c", "description": "d"}'),
        ("2", '{"source_id": "k", "company": "c", "description": "d"}'),
        ("3", '{"source_id": "k"'),
        ("4", "[1]"),
        ("5", '{"source_id": 7, "job_title": "t", "company": "c", "description": "d", "more": {}}'),
    ]
    records = parse_records(spark.createDataFrame(texts, "doc_key string, value string"))
    errors = {r.doc_key: r.load_error for r in records.collect()}
    assert errors == {"1": None, "2": "missing job_title", "3": "not a JSON object", "4": "not a JSON object", "5": None}
    staged = upsert.stage(records)
    assert {r.source_id: r.content_hash for r in staged.collect()} == {"k": sha(None, "c", "d"), "7": sha("t", "c", "d")}
    actions = upsert.upsert_actions(staged, spark.createDataFrame([], JOBS))
    assert tuple(upsert.load_summary(records, actions).first()) == (5, 2, 0, 3)
