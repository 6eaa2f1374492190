import numpy as np
import pytest

from hiremill.llm.families import group_links
from hiremill.llm.minhash import minhash_components
from hiremill.llm.shingles import Shingler
from tests.llm.helpers import EDGES, documents, words

BIG = 9_007_199_254_740_993


def shingles(text, n=4):
    out, word = [], ""
    for ch in (text or "") + " ":
        if ch in " \t\n\v\f\r":
            if word:
                out.append(word)
            word = ""
        else:
            word += ch.lower() if "A" <= ch <= "Z" else ch
    if len(out) < n:
        return {tuple(out)} if out else set()
    return {tuple(out[i : i + n]) for i in range(len(out) - n + 1)}


def brute(rows, percent=80):
    """Row number -> (size, smallest id of its component), by all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both, all_ = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if all_ and 100 * both >= percent * all_:
                parent[find(i)] = find(j)
    name = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            name[find(i)] = min(name.get(find(i), doc), doc)
    return [(len(sets[i]), name.get(find(i))) for i in range(len(rows))]


def check(spark, rows, **options):
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_components(documents(spark, [r for r in rows if r[0] is not None], True), **options).collect())
    rows = [r for r in rows if r[0] is not None]
    assert got == sorted((doc, n, name, doc == name) for (doc, _), (n, name) in zip(rows, brute(rows)))


def family(size, most, seed, length=120, tail=0):
    """Copies of one text with up to ``most`` words changed, some cut at the end."""
    rng = np.random.default_rng(seed)
    base = words(5000, length, seed).split()
    out = []
    for i in range(size):
        copy = list(base)
        for at in rng.choice(length, rng.integers(0, most + 1), replace=False):
            copy[at] = f"x{rng.integers(10**9)}"
        out.append(" ".join(copy[: length - int(rng.integers(0, tail + 1))]))
    return out


def test_equals_brute_force_with_edges_and_clashing_columns(spark):
    texts = [words(40, 30, s) for s in range(40)] + family(30, 4, 1) + family(12, 2, 2, 50)
    texts += [texts[0] + " end", texts[0].upper(), "a b c", "A  b\tc", "a b"]
    check(spark, EDGES + [(i, t) for i, t in enumerate(texts)])


def test_large_families_at_the_threshold(spark):
    # Most of a family does not link with its middle; sizes differ, and parts of it share passages the rest lacks.
    texts = family(90, 9, 3, tail=25) + family(60, 7, 4, 80) + [f"{t} {words(900, 22, 9)}" for t in family(40, 3, 3)]
    check(spark, [(i, t) for i, t in enumerate(texts)], small=3)


def test_groups_without_a_middle(spark):
    rng = np.random.default_rng(5)
    # Overlapping windows of one long range: each is similar to its neighbours only.
    sets = [np.arange(i * 6, i * 6 + 100 + int(rng.integers(0, 12)), dtype=np.uint64) for i in range(60)]
    table = spark.createDataFrame([(i, len(s), s.tobytes(), 1.0) for i, s in enumerate(sets)], "set_no long, size long, members binary, central double")
    groups = spark.createDataFrame([(7, i) for i in range(60)], "g long, set_no long")
    none = spark.createDataFrame([], "a long, b long")
    from hiremill.llm.components import connected_components

    for rounds, long in ((1, 5), (3, 5), (2, 100)):
        labels = {r.node: r.label for r in connected_components(group_links(groups, none, table, 80, small=2, long=long, rounds=rounds)).collect()}
        parent = list(range(60))
        for i in range(60):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    old = parent[i]
                    parent = [parent[j] if p == old else p for p in parent]
        least = {}
        for i in range(60):
            least.setdefault(parent[i], i)
        assert [labels.get(i, i) for i in range(60)] == [least[parent[i]] for i in range(60)]


def test_missing_and_large_ids(spark):
    text = words(500, 40, 1)
    rows = [(None, text), (BIG + 2, text), (BIG, text + " more"), (None, "alone in the world here"), (None, None), (BIG + 4, words(500, 40, 2))]
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_components(documents(spark, rows)).collect()}
    assert got == {
        (None, 37, BIG, None), (BIG + 2, 37, BIG, False), (BIG, 38, BIG, True), (None, 2, None, None), (None, 0, None, None), (BIG + 4, 37, BIG + 4, True),
    }


def test_empty_table(spark):
    assert minhash_components(documents(spark, [])).collect() == []


@pytest.mark.parametrize("n", [1, 4])
def test_shingler_equals_plain_loop(n):
    texts = ["a b c d e", "", " \n", "one", "A\x0bb\x0cC\r\nd é É", "x " * 70_000 + "end", "word" * 400_000 + " b c d e"]
    for text, got in zip(texts, Shingler(n).sets(t.encode() for t in texts), strict=True):
        assert len(got) == len(shingles(text, n)) and (np.diff(got.astype(object)) > 0).all()
    same = list(Shingler(n).sets([b"A b C d E", b"a B c D e", b"a B c D f"]))
    assert (same[0] == same[1]).all() and not np.array_equal(same[0], same[2])


def test_components_are_not_searched_anew_for_links_within_them(spark, monkeypatch):
    from hiremill.llm import components

    written = []
    materialize = components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, label: written.append(label) or materialize(df, label))
    check(spark, [(i, t) for i, t in enumerate(family(40, 2, 5) + family(30, 2, 6))], small=3)
    # One search for all links of the families; before, there was one for each step and one at the end.
    assert 0 < written.count("component-links") <= 2 and written.count("component-labels") <= 4
