"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence has the probability
sigmoid(bias + sum of the weights of its distinct features), its features being
words and the five-letter starts of longer words. The document's probability is
the noisy-or over its sentences, 1 - prod(1 - p). Only documents carry labels;
the gradient of the noisy-or passes their error to the sentences that cause it,
so the trained model also says which sentences offend.

Training takes a bounded sample of each class, weighted back to the class
shares of all labelled rows; scoring reads whole texts. NULL and empty texts have
no sentence: score 0. Labels other than 0 and 1 and NULL ids teach nothing.
Without both classes among the training rows every score is 0. Ties for the
worst sentence go to the first. Extra columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiremill.llm.common import fold, map_frames, sample_by_hash, sigmoid, table
from hiremill.session import materialize

PER_CLASS = 8000
THRESHOLD = 0.3
MOST_FEATURES = 4000
CACHE = 400_000
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")
START = 5


def word_features(word: str) -> tuple[str, ...]:
    return (word, "^" + word[:START]) if len(word) > START else (word,)


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the pieces between full stops, marks and line ends that hold a word."""
    return [m.span() for m in SENTENCE.finditer(text) if WORD.search(m[0])]


def bag(text: str | None) -> list[set[str]]:
    """The distinct features of each sentence."""
    text = (text or "").lower()
    return [{f for w in WORD.findall(text[a:b]) for f in word_features(w)} for a, b in sentences(text)]


def telling_features(sample: DataFrame, most: int = MOST_FEATURES) -> list[str]:
    """The features whose share of documents differs most between the classes, by at least four standard errors."""

    def run(batches):
        for pdf in batches:
            rows = [(f, y) for t, y in zip(pdf["text"], pdf["toxic"]) if (b := bag(t)) for f in set().union(*b)]
            yield pd.DataFrame(rows, columns=["feature", "toxic"])

    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = (float(max(sizes.get(v, 0), 1)) for v in (0, 1))
    pool = F.col("n") / (n0 + n1)
    off = F.abs(F.col("hits") / n1 - (F.col("n") - F.col("hits")) / n0)
    return [
        r["feature"]
        for r in sample.select("text", "toxic").mapInPandas(run, "feature string, toxic int")
        .groupBy("feature").agg(F.sum("toxic").alias("hits"), F.count("*").alias("n"))
        .filter("n >= 4")
        .withColumn("errors", off / F.sqrt(pool * (1 - pool) * (1 / n0 + 1 / n1) + 1e-12))
        .filter("errors > 4").orderBy(F.desc("errors"), "feature").limit(most).collect()
    ]


def bag_rows(sample: DataFrame, features: list[str]) -> list:
    """Per document its label, number of sentences, and (sentence, feature number) of the telling features."""
    at = {f: i for i, f in enumerate(features)}

    def run(batches):
        for pdf in batches:
            rows = []
            for t, y in zip(pdf["text"], pdf["toxic"]):
                bags = bag(t)
                hits = [(i, at[f]) for i, b in enumerate(bags) for f in sorted(b) if f in at]
                rows.append((y, len(bags), [i for i, _ in hits], [f for _, f in hits]))
            yield pd.DataFrame(rows, columns=["toxic", "sentences", "sent", "feat"])

    return sorted(sample.select("text", "toxic").mapInPandas(run, "toxic int, sentences int, sent array<int>, feat array<int>").collect())


def fit_mil(rows: list, features: list[str], class_rows: dict[int, int], rounds: int = 500) -> dict:
    """Weights by feature and the bias, by Adam with a soft threshold on the weights.

    ``rows`` are those of ``bag_rows``; ``class_rows`` says for how many labelled
    documents those of each class stand.
    """
    y = np.array([r[0] for r in rows], dtype=float)
    doc_of = np.repeat(np.arange(len(rows)), [r[1] for r in rows])
    first_sentence = np.cumsum([0, *(r[1] for r in rows)])
    sent = np.array([first_sentence[d] + s for d, r in enumerate(rows) for s in r[2]], dtype=np.int64)
    feat = np.array([f for r in rows for f in r[3]], dtype=np.int64)
    weight = np.where(y == 1, class_rows[1] / max((y == 1).sum(), 1), class_rows[0] / max((y == 0).sum(), 1))
    w, bias = np.zeros(len(features)), -6.0
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    scale = weight / weight.sum()
    for i in range(1, rounds + 1):
        z = bias + np.bincount(sent, weights=w[feat], minlength=len(doc_of))
        p = np.clip(sigmoid(z), 1e-12, 1 - 1e-9)
        none = np.bincount(doc_of, weights=np.log1p(-p), minlength=len(y))
        doc_p = np.clip(-np.expm1(none), 1e-9, 1 - 1e-9)
        # d loss / d z of a sentence: p for a clean document, p (1 - 1 / P) for a toxic one.
        pull = scale[doc_of] * p * np.where(y[doc_of] == 1, 1.0 - 1.0 / doc_p[doc_of], 1.0)
        grad = np.append(np.bincount(feat, weights=pull[sent], minlength=len(w)), pull.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        step = 0.15 * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.99**i)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
        w = np.sign(w) * np.maximum(np.abs(w) - 0.0003, 0.0)
    return {"weights": {f: float(v) for f, v in zip(features, w) if v}, "bias": float(bias)}


class Scorer:
    """Sentence probabilities of texts; remembers the weights of a bounded number of words."""

    def __init__(self, model: dict):
        self.model, self.known = model, {}

    def weight(self, word: str) -> float:
        get = self.model["weights"].get
        return sum(get(f, 0.0) for f in word_features(word))

    def sentence(self, words: list[str]) -> float:
        """The summed weights of the distinct features."""
        known, found = self.known, {}
        for w in words:
            v = known.get(w)
            if v is None:
                if len(known) >= CACHE:
                    known.clear()
                v = known[w] = self.weight(w)
            if v:
                found[w] = v
        if len(found) < 2:
            return sum(found.values())
        get = self.model["weights"].get
        return sum(get(f, 0.0) for f in {f for w in found for f in word_features(w)})

    def document(self, text: str | None) -> tuple[float, int, int, float]:
        """Probability, start and end of the worst sentence (-1 without one) and its probability."""
        low = (text or "").lower()
        if text and len(low) != len(text):  # a letter whose lower case is longer: keep positions true
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        none, plain = 0.0, 0
        worst, start, end = -1.0, -1, -1
        bias = self.model["bias"]
        base = float(sigmoid(bias))
        for m in SENTENCE.finditer(low):
            words = WORD.findall(m[0])
            if not words:
                continue
            v = self.sentence(words)
            if v == 0.0:
                plain += 1
                p = base
            else:
                p = float(sigmoid(bias + v))
                none += np.log1p(-min(p, 1 - 1e-12))
            if p > worst:
                worst, (start, end) = p, m.span()
        none += plain * np.log1p(-base)
        return float(-np.expm1(none)), start, end, max(worst, 0.0)


def train_toxicity_model(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> dict | None:
    """Fit on at most ``per_class`` toxic and as many clean labelled documents, those whose ids have the smallest hash."""
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    parts = [sample_by_hash(usable.filter(F.col("toxic") == v), "doc_id", per_class) for v in (0, 1)]
    # Proven bound: 2 x per_class rows of two numbers.
    sample = docs.select("doc_id", "text").join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id").select("text", "toxic")
    sample = materialize(sample, "toxicity-sample")
    features = telling_features(sample)
    rows = bag_rows(sample, features)
    return fit_mil(rows, features, counts) if len({r[0] for r in rows}) == 2 else None


def score_toxicity(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, and where the worst sentence is (characters) with its own probability."""

    def run(batches):
        scorer = Scorer(model or {"weights": {}, "bias": -50.0})
        for pdf in batches:
            found = [scorer.document(t) for t in pdf["text"]]
            score, start, end, worst = zip(*found) if found else ((),) * 4
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": score, "worst_start": start, "worst_end": end, "worst_score": worst})

    kind = docs.schema[id_col].dataType.simpleString()
    return map_frames(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, f"doc_id {kind}, score double, worst_start long, worst_end long, worst_score double"
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document; the quarter with crc32 remainder 2 is held out of training."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train_toxicity_model(docs, labels.filter(fold("doc_id", 4) != 2))
    return score_toxicity(docs, model).select(
        "doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "worst_start", "worst_end", "worst_score",
    )
