import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from hiremill.llm import divergence
from hiremill.llm.divergence import PerfectHash, probabilities, source_divergence, term_hash, terms
from tests.llm.helpers import words

SCHEMA = "doc_id long, text string, lang string, source string"


def brute(rows, least=3, most=200):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))) for _, text, lang, source in rows]
    seen, groups = defaultdict(Counter), defaultdict(set)
    for lang, source, found in docs:
        seen[lang].update(set(found))
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = {t for t, n in seen[lang].items() if n >= least}
        counts = {s: Counter() for s in sources}
        for of, source, found in docs:
            if of == lang:
                counts[source].update(t for t in found if t in kept)
        every = sum(counts.values(), Counter())
        p = {s: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept} for s, c in counts.items()}
        q = {t: 1 + 10**9 * (every[t] + 1) // (sum(every.values()) + len(kept)) for t in kept}
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in sources - {s}]
            own = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, listed in (("pair", sorted(pairs)), ("term", sorted(own)[:most])):
                out |= {(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(listed)}
    return out


def corpus():
    rows = [(i, words(60, 40 + i % 7, i).upper() if i % 3 else words(90, 30, i), ["en", "fr", None][i % 3], [f"s{i % 5}", None, ""][i % 3 if i % 4 else 0]) for i in range(60)]
    rows += [(None, None, None, None), (1, "", "xx", "a"), (1, "", "xx", "a"), (2, " \n12 34!", "xx", None), (3, "é日本É Été été ÉTÉ naïve\x00naïve", "yy", "b")] * 2
    rows += [(900, "long tail " * 40_000 + "é" * 30_000, "en", "s1"), (901, "tie tied ties", "en", "s9"), (902, "tie tied ties", "en", "s8"), (903, "ties tied tie", "en", "s7")]
    return rows + [(904, "alone", "one", "only")] * 3


def got(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS rank", "'x' AS term", "2L AS n", "'y' AS part", "3 AS shards").repartition(3)
    out = source_divergence(df, **options).collect()
    assert len(out) == len(set(out))
    return {tuple(r) for r in out}


@pytest.mark.parametrize("options", [{}, {"shard_terms": 7, "round_bytes": 400}, {"least_documents": 1, "most_terms": 4, "cells": 40}])
def test_equals_brute_force(spark, monkeypatch, options):
    if options:
        monkeypatch.setattr(divergence, "HELD_TERMS", 25)
        monkeypatch.setattr(divergence, "HELD_SLOTS", 30)
    rows = corpus()
    want = brute(rows, options.get("least_documents", 3), options.get("most_terms", 200))
    assert len(want) > 100 and got(spark, rows, **options) == want


def test_empty_table_and_no_vocabulary(spark):
    assert got(spark, []) == set()
    rows = [(1, "one two", "en", "b"), (2, "three", "en", "a"), (3, None, "fr", "c")]
    assert got(spark, rows) == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)}


def test_hash_is_sparks(spark):
    for word in (b"", b"term", "été日本".encode(), b"x" * 77):
        value = spark.sql(f"SELECT xxhash64(X'{word.hex()}') AS v").first().v
        assert np.uint64(term_hash(word)).view(np.int64) == value == np.uint64(xxhash.xxh64_intdigest(word, 42)).view(np.int64)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    keys = np.array([term_hash(str(i).encode()) for i in range(n)], dtype=np.uint64)
    made = PerfectHash.unpacked(PerfectHash.of(keys).packed())
    assert sorted(made.slot(keys).tolist()) == list(range(n))
    others = np.array([term_hash(f"not {i}".encode()) for i in range(100)], dtype=np.uint64)
    assert ((0 <= made.slot(others)) & (made.slot(others) <= max(n - 1, 0))).all()


def test_perfect_hash_of_equal_keys_is_none():
    assert PerfectHash.of(np.array([5, 9, 5], dtype=np.uint64)) is None


def test_probabilities_are_exact_and_terms_are_cut_between(monkeypatch):
    rng = np.random.default_rng(1)
    total = 8 * 10**15 + 7
    counts = np.append(rng.integers(0, total, 200), [0, total - 1])
    assert probabilities(counts, np.int64(total)).tolist() == [1 + 10**9 * (c + 1) // total for c in counts.tolist()]
    monkeypatch.setattr(divergence, "PIECE", 3)
    assert [t for piece in terms("Été 1abc-DEF\x7fgh".encode()) for t in piece] == ["Été".encode(), b"abc", b"def", b"gh"]
