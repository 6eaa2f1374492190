import zlib

import numpy as np
import pytest

from hiremill.llm import language, quality, toxicity
from tests.llm.helpers import EDGES, documents

SF = "/root/testdata/sf0.01"


def crc(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def accuracy(got, labels, column):
    held = [(r.predicted, labels[r.doc_id][column]) for r in got if r.held_out and r.doc_id in labels]
    assert len(held) > 50
    return np.mean([a == b for a, b in held])


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


@pytest.mark.parametrize("query, parts, rest, column, least", [(quality.op3_quality, 5, 0, "quality", 0.95), (toxicity.op8_toxicity, 4, 2, "toxic", 0.9)])
def test_held_out_accuracy(spark, labels, query, parts, rest, column, least):
    got = query(spark, SF).collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (crc(r.doc_id, parts) == rest) for r in got)
    assert accuracy(got, labels, column) >= least


def test_language_of_held_out_documents(spark):
    got = language.op10_language_id(spark, SF).collect()
    said = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    assert all(r.held_out == (crc(r.doc_id, 4) == 2) for r in got)
    held = [r.lang_pred == said[r.doc_id] for r in got if r.held_out]
    assert np.mean(held) > 0.98


def test_families_come_from_the_texts():
    x = np.array([[1, 0, 0.1, 0], [1, 0, 0, 0.1], [0, 1, 0.1, 0], [0, 1, 0, 0.1]])
    assert sorted(map(sorted, language.families(x, 2))) == [[0, 1], [2, 3]]


def test_language_edges(spark):
    docs = documents(spark, EDGES, extra=True)
    texts = [(i, f"{'the house of this and ' if i % 2 else 'der und die ist nicht '}{i}", "en" if i % 2 else "de") for i in range(40)]
    model = language.train_language_model(spark.createDataFrame([*texts, (99, "x", None), (98, None, "en")], "doc_id long, text string, lang string"))
    got = {r.doc_id: r for r in language.identify_language(docs, model).collect()}
    assert {d for d, r in got.items() if r.lang_pred == "und"} == {900, 901, 902, 903} and got[900].score == 0.0
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language.train_language_model(empty) is None
    assert {r.lang_pred for r in language.identify_language(docs, None).collect()} == {"und"}
    assert language.identify_language(documents(spark, []), model).count() == 0


def test_trigrams_of_pieces_are_those_of_the_whole(monkeypatch):
    text = "abcdéfgh " * 50
    whole = language.trigram_profile(text)
    monkeypatch.setattr("hiremill.llm.common.CHUNK", 37)
    assert np.allclose(language.trigram_profile(text), whole)


def test_quality_edges(spark):
    docs = documents(spark, EDGES, extra=True)
    labels = spark.createDataFrame([(904, 1, None), (906, 0, None), (None, 1, None), (905, None, None), (903, 7, None)], "doc_id long, quality int, toxic int")
    model = quality.train_quality_model(docs, labels)
    got = quality.score_quality(docs, model).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
    assert quality.train_quality_model(docs, labels.filter("false")) is None
    assert {r.score for r in quality.score_quality(docs, None).collect()} == {0.5}


def test_gam_learns_a_pair_that_no_feature_shows():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) == (x[:, 1] > 0.5)).astype(float)
    model = quality.fit_gam(x, y, rounds=60)
    assert any({a, b} == {0, 1} for a, b, *_ in model["pairs"])
    assert np.mean((quality.score_gam(model, x) > 0.5) == y) > 0.9
    z = model["bias"] + sum(t[np.searchsorted(c, x[:, i], side="right")] for i, (t, c) in enumerate(zip(model["tables"], model["cuts"])))
    assert np.allclose(quality.score_gam({**model, "pairs": []}, x), 1 / (1 + np.exp(-z)))


def test_noisy_or_finds_the_sentence():
    rows = [(i % 2, 3, [0, 1, 2, 2], [0, 0, 0, 1 if i % 2 else 0]) for i in range(200)]
    model = toxicity.fit_mil([(y, n, s, f) for y, n, s, f in rows], ["plain", "bad"], {0: 100, 1: 100})
    score, start, end, worst = toxicity.Scorer(model).document("Plain words. A bad thing! Plain again.")
    assert score > 0.9 and "A bad thing" in "Plain words. A bad thing! Plain again."[start:end] and worst > 0.9
    p = [0.2, 0.5]
    assert abs((1 - np.prod(1 - np.array(p))) - 0.6) < 1e-12
    assert toxicity.Scorer(model).document("plain words. plain.")[0] < 0.1


def test_toxicity_edges(spark):
    docs = documents(spark, EDGES, extra=True)
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, {"weights": {"twice": 9.0}, "bias": -5.0}).collect()}
    assert got[900].score == got[901].score == got[902].score == 0.0 and got[900].worst_start == -1
    assert got[906].score > 0.5 and got[905].score < 0.05
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.train_toxicity_model(docs, none) is None
    assert {r.score for r in toxicity.score_toxicity(docs, None).collect()} == {0.0} or max(r.score for r in toxicity.score_toxicity(docs, None).collect()) < 1e-15
