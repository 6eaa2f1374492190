import numpy as np
import pytest
from pyspark.sql import functions as F

from hiremill.llm.neighbours import nearest
from hiremill.llm.topk import top_k_search


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    x = centres[rng.integers(0, 12, 1500)] + 0.7 * rng.normal(size=(1500, 16))
    x[100:140] = x[100]  # copies: ties everywhere
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def frame(spark, x, extra=()):
    rows = [(i, [float(v) for v in r], "x") for i, r in enumerate(x)] + list(extra)
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, block string")


ODD = [(20_000, None, "x"), (20_020, [], "x"), (20_040, [float("nan")] * 16, "x"), (20_060, [None] * 16, "x"), (20_080, [float("inf")] * 16, "x"), (20_100, [1.0], "x")]


def ranked(score, ids, q, k):
    s = score.copy()
    order = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-s[i], ids[i]))[:k]
    return [(ids[i], s[i]) for i in order]


def test_exact_top_k_is_brute_force(spark, vectors):
    got = {}
    for r in top_k_search(frame(spark, vectors, ODD), F.col("vec_id") % 20 == 0, k=20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    q = np.floor(64 * vectors).astype(np.int64)
    assert set(got) == set(range(0, 1500, 20))
    for i, rows in got.items():
        assert [(v, s) for _, v, s in sorted(rows)] == ranked(q @ q[i], list(range(1500)), i, 20)
        assert [r for r, *_ in sorted(rows)] == list(range(1, 21))


def test_approximate_search_finds_nine_of_ten(spark, vectors, monkeypatch):
    monkeypatch.setattr("hiremill.llm.neighbours.LIST_ROWS", 60)
    monkeypatch.setattr("hiremill.llm.neighbours.CELL_ROWS", 500)
    got = {}
    for r in nearest(frame(spark, vectors, ODD), F.col("vec_id") % 20 == 0, k=20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = 0
    for i in range(0, 1500, 20):
        s = vectors @ vectors[i]
        assert [r for r, *_ in sorted(got[i])] == list(range(1, 21))
        assert all(abs(s[v] - score) < 1e-12 and v != i for _, v, score in got[i])
        assert [x[1:] for x in sorted(got[i])] == [x[1:] for x in sorted(got[i], key=lambda x: (-x[2], x[1]))]
        least = ranked(s, list(range(1500)), i, 20)[-1][1]
        hits += sum(score >= least - 1e-12 for *_, score in got[i])
    assert hits / (75 * 20) >= 0.9


@pytest.mark.parametrize("search", [top_k_search, nearest])
def test_edges(spark, search):
    few = frame(spark, [[1.0, 0.0], [0.0, 1.0], [1.0, 0.0]])
    got = sorted((r.query_id, r.rank, r.vec_id) for r in search(few, F.col("vec_id") == 0, k=20).collect())
    assert got == [(0, 1, 2), (0, 2, 1)]
    assert search(few.filter("false"), F.col("vec_id") == 0).count() == 0
    assert search(few.filter("vec_id = 0"), F.col("vec_id") == 0).count() == 0
    assert search(few, F.col("vec_id") == 77).count() == 0
