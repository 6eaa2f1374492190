import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from hiremill.llm.components import connected_components
from hiremill.llm.jaccard import Bands, jaccard_components, shingle_set, signatures
from tests.llm.helpers import EDGES, documents


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def brute(rows):
    sets, parent, holds = {}, {}, defaultdict(list)
    for d, t in rows:
        sets[d], parent[d] = shingles(t), d

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d, s in sets.items():
        for x in s:
            holds[x].append(d)
    for d, s in sets.items():
        for other, n in Counter(o for x in s for o in holds[x] if o < d).items():
            if 100 * n >= 80 * (len(s) + len(sets[other]) - n):
                a, b = sorted((root(d), root(other)))
                parent[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


@pytest.fixture(scope="module")
def rows():
    rng, names, out = random.Random(7), [f"w{i}" for i in range(50)], []

    def edited(base, most, word):
        t = list(base)
        for _ in range(rng.randint(0, most)):
            if t:
                t[rng.randrange(len(t))] = word()
        out.append((len(out), " ".join(t)))

    for _ in range(40):
        base = [rng.choice(names) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(1, 6)):
            edited(base, 3, lambda: rng.choice(names))
    base = [rng.choice(names) for _ in range(150)]
    for _ in range(120):  # one large group of near copies
        edited(base, 4, lambda: f"z{rng.randrange(1000)}")
    passage = [rng.choice(names) for _ in range(60)]
    for _ in range(120):  # one passage in otherwise different texts
        own = [f"y{rng.randrange(3000)}" for _ in range(rng.randint(3, 60))]
        out.append((len(out), " ".join(own[:5] + passage + own[5:])))
    return out


@pytest.mark.parametrize("small", [48, 5])
def test_against_brute_force(spark, rows, small):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(documents(spark, rows).repartition(5), small=small).collect()}
    assert got == brute(rows)


def test_edges(spark):
    got = jaccard_components(documents(spark, EDGES, extra=True)).collect()
    assert sorted({(r.doc_id, r.n_shingles, r.component_id) for r in got}) == sorted((d, n, c) for d, (n, c) in brute(EDGES).items())
    assert len(got) == len(EDGES) and jaccard_components(documents(spark, [])).count() == 0


def test_similar_sets_share_as_many_signatures_as_they_must():
    rng = np.random.default_rng(2)
    for fine in (1.2, 8.0):
        bands = Bands(80, fine)
        for size in (4, 5, 7, 10, 23, 60, 200, 900):
            for _ in range(40):
                a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
                swap = int(rng.integers(0, len(a) // 9 + 1))
                drop = int(rng.integers(0, max(1, len(a) // 9)))
                b = np.unique(np.concatenate([a[swap + drop :], rng.integers(0, 2**63, swap, dtype=np.uint64)]))
                both = len(np.intersect1d(a, b))
                if 100 * both < 80 * (len(a) + len(b) - both) or (a.tobytes() == b.tobytes()):
                    continue
                x, y = signatures(a, bands), signatures(b, bands)
                places = set(x[1]) & set(y[1])
                shared = {p: len(np.intersect1d(x[0][x[1] == p], y[0][y[1] == p])) for p in places}
                need = {p: max(x[2][x[1] == p][0], y[2][y[1] == p][0]) for p in places}
                assert any(shared[p] >= need[p] for p in places), (fine, size, len(a), len(b), both)


def test_long_words_and_pieces_hash_the_same(monkeypatch):
    text = "Alpha beta\tGAMMA " * 40_000
    assert len(shingle_set(text)) == 3
    assert (shingle_set("A b C d E f") == shingle_set("a B\nc D\te F")).all()
    assert len(shingle_set("x" * 400_000 + " a b c d e")) == 2


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)] + [(5, 5), (None, 3)]
    parent = {x: x for pair in links if None not in pair and pair[0] != pair[1] for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}


def test_sets_sign_half_as_often_as_they_have_elements():
    rng, bands = np.random.default_rng(5), Bands()
    sets = [np.unique(rng.integers(0, 2**64 - 1, size, dtype=np.uint64)) for size in range(50, 1500, 10)]
    assert sum(len(signatures(s, bands)[0]) for s in sets) <= 0.53 * sum(map(len, sets))


def test_large_families_are_measured_against_few_pivots(spark, monkeypatch):
    from hiremill.llm import families, jaccard

    rng, written = random.Random(11), []

    def counted(df, label):
        made = materialize(df, label)
        if label in ("family-stars", "jaccard-pivots", "jaccard-fine"):
            written.append(made.count())
        return made

    materialize = jaccard.materialize
    monkeypatch.setattr(jaccard, "materialize", counted)
    monkeypatch.setattr(families, "materialize", counted)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    rows = []
    for i in range(150):
        own = list(base)
        for _ in range(rng.randint(1, 6)):
            own[rng.randrange(len(own))] = f"z{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(documents(spark, rows).repartition(3)).collect()}
    assert got == brute(rows) and 0 < sum(written) <= 10 * len(rows)


def test_sets_of_a_family_are_measured_about_once_and_those_of_one_component_are_not_compared(spark, monkeypatch):
    from hiremill.llm import families, jaccard

    rng, written = random.Random(23), defaultdict(int)

    def counted(df, label):
        made = materialize(df, label)
        written[label] += made.count()
        return made

    materialize = jaccard.materialize
    monkeypatch.setattr(jaccard, "materialize", counted)
    monkeypatch.setattr(families, "materialize", counted)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    rows = []
    for i in range(400):  # some are near the base, some only near another, some near none
        own = list(base)
        for _ in range(rng.randint(1, 14)):
            own[rng.randrange(len(own))] = f"z{rng.randrange(60)}"
        rows.append((i, " ".join(own)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(documents(spark, rows).repartition(3)).collect()}
    assert got == brute(rows)
    assert 0 < written["family-stars"] <= 2 * len(rows) and written["family-differences"] <= 30 * len(rows)


def test_parities_never_differ_in_more_bits_than_the_sets_in_elements():
    from hiremill.llm.families import apart_at_least, parity

    rng, tight = np.random.default_rng(9), 0
    for size in (1, 2, 5, 31, 32, 33, 100, 450, 3000, 200_000):
        for _ in range(8):
            a = np.unique(rng.integers(0, 2**64 - 1, size, dtype=np.uint64))
            b = np.unique(np.concatenate([a[int(rng.integers(0, len(a))) :], rng.integers(0, 2**64 - 1, int(rng.integers(0, size)), dtype=np.uint64)]))
            apart, found = len(np.setxor1d(a, b)), apart_at_least(parity(a), parity(b))
            assert found <= apart and apart_at_least(parity(a), parity(a)) == 0
            tight += 2 * found > apart
    assert tight >= 40
