import hashlib
import random

import duckdb
import pandas as pd
import pytest

from hiremill.llm.line_dedup import MIN_CHARS, OP4_SQL, dedup_lines
from tests.llm.helpers import EDGES, documents


def edits(x: str, y: str) -> int:
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        new = [i]
        for j, b in enumerate(y, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return row[-1]


def brute(rows):
    seen, out = [], {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        kept = []
        for line in (text or "").split("\n"):
            if not line.strip(" \t\r"):
                kept.append(line)
                continue
            near = any(line == s or (min(len(line), len(s)) >= MIN_CHARS and abs(len(line) - len(s)) <= 1 and edits(line, s) <= 1) for s in seen)
            if not near:
                kept.append(line)
            seen.append(line)
        out[doc] = None if text is None else "\n".join(kept)
    return out


@pytest.fixture(scope="module")
def rows():
    rng, letters = random.Random(5), "abcé 日"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(17, 34))) for _ in range(15)]
    out = []
    for d in range(40):
        lines = []
        for _ in range(rng.randint(0, 8)):
            x = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 1, 2])):
                kind, i = rng.randrange(3), rng.randrange(len(x))
                x[i : i + (kind < 2)] = [] if kind == 0 else [rng.choice(letters)]
            lines.append("".join(x) if rng.random() < 0.9 else rng.choice(["", " ", "ab", "ac"]))
        out.append((d, "\n".join(lines)))
    return out + [(100, None), (101, ""), (102, "\n\n")]


def test_against_brute_force_and_sql(spark, rows):
    got = {r.doc_id: r.text for r in dedup_lines(documents(spark, rows)).collect()}
    assert got == brute(rows)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    hashed = {d: None if t is None else hashlib.md5(t.encode()).hexdigest() for d, t in got.items()}
    assert {d: m for d, _, _, m in con.execute(OP4_SQL).fetchall()} == hashed


def test_edges_and_other_columns(spark):
    got = dedup_lines(documents(spark, EDGES, extra=True))
    assert {"shard", "line", "first", "label", "n_lines", "n_kept"} <= set(got.columns)
    by_id = {}
    for r in got.collect():
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[900][0].text is None and by_id[900][0].n_lines == 0
    assert by_id[901][0].text == "" and by_id[905][0].text == "word " * 30_000
    assert [r.text for r in by_id[906]] == ["twice the row"] * 2
    assert dedup_lines(documents(spark, [])).count() == 0


def test_no_python_in_the_plan(spark, rows):
    plan = dedup_lines(documents(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
