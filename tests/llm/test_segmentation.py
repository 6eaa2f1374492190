import random
from itertools import product

import numpy as np
import public_tokenizers
import pytest

from hiremill.llm.segmentation import SPACE, Segmenter, best_sums, decode_documents, encode_documents, op1_sentencepiece
from tests.llm.helpers import EDGES, SF, documents

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def segmenter():
    return Segmenter(PATH, 4)


def every_path(s, text):
    x, out = SPACE + text.replace(" ", SPACE), []

    def walk(at, score, ids):
        if at == len(x):
            out.append((score, tuple(ids)))
        for e in range(at + 1, min(len(x), at + s.longest) + 1):
            v = s.score.get(x[at:e])
            if v is not None or e == at + 1:
                walk(e, score + (s.unknown if v is None else v), ids + s._ids(x[at:e]))

    walk(0, 0.0, [])
    return sorted(out, key=lambda r: -r[0])


@pytest.mark.parametrize("text", ["hello a", "ab\ncd", "  x é日b", "thé ☃ a", "aaaa", "Of the on", "a"])
def test_the_best_of_all_paths(segmenter, text):
    want, (got,) = every_path(segmenter, text), segmenter.encode([text])
    assert [s for s, _ in got] == [s for s, _ in want[:4]]
    assert all((s, tuple(np.frombuffer(i, dtype="<u4").tolist())) in want for s, i in got) and len({i for _, i in got}) == len(got)
    assert segmenter.decode(got[0][1]) == text


def test_best_sums_are_those_of_the_product():
    rng = random.Random(3)
    for most in (1, 2, 3, 5, 8):
        for _ in range(40):
            lists = [sorted(((-rng.randrange(4), bytes([k, j])) for j in range(rng.randint(1, most))), key=lambda c: -c[0]) for k in range(rng.randint(1, 4))]
            every = sorted((-sum(c[0] for c in way), k, way) for k, way in enumerate(product(*lists)))[:most]
            assert best_sums(lists, most) == [(-minus, way) for minus, _, way in every]


def test_many_paths_of_one_line():
    """The product of these lists would hold 40 ** 39 choices."""
    line = " ".join(f"wordless{i} unthinkably" for i in range(40))
    (few,), (many,) = Segmenter(PATH, 4).encode([line]), Segmenter(PATH, 40).encode([line])
    assert [s for s, _ in many[:4]] == [s for s, _ in few] and many[0] == few[0] and len({i for _, i in many}) == 40 and [s for s, _ in many] == sorted((s for s, _ in many), reverse=True)


def test_arrays_and_single_parts_agree(segmenter):
    parts = [f"{SPACE}{w}" for w in "the house of stone and water where nobody ever lived in peace for very long until today arrived".split()]
    same = [p + c for p in parts for c in "abcdefghij"]
    segmenter.learn_many(same)
    for p in same:
        learned = segmenter.known[p]
        best = segmenter.best_paths(p, 2)
        assert learned == segmenter._learn(p) and best[0] == (learned[1], learned[0]) and best[1][0] == learned[1] - learned[2]


def test_edges_and_round_trip(spark):
    docs = documents(spark, EDGES, extra=True)
    encoded = encode_documents(docs)
    back = sorted((r.doc_id, r.text) for r in decode_documents(encoded).collect())
    assert back == sorted((d, t or "") for d, t in EDGES)
    assert {len(r.scores) for r in encoded.filter("doc_id in (900, 901)").collect()} == {1}
    assert encode_documents(documents(spark, [])).count() == 0


def test_query(spark):
    rows = op1_sentencepiece(spark, SF).collect()
    assert len(rows) == 200 and all(r.round_trip and r.n_best_scores == sorted(r.n_best_scores, reverse=True) for r in rows)
