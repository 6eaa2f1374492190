"""Language identification by hierarchical discrimination.

The languages of the training rows are first gathered into families by
average-linkage clustering of their byte-trigram profiles (about the square
root of their number). A document is given a family, then a language within it;
both steps vote over one-versus-one linear support vector machines (squared
hinge). Profiles are hashed counts of the trigrams of the lower-cased UTF-8
text, over the whole text, read in chunks of bounded size.

The score is the product of the two steps' least winning margins, each put
through a sigmoid. NULL texts and texts without a letter are ``und`` with score
0; so is every text if there is no training row. Nothing but the text is read
for a prediction; NULL languages teach nothing; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiremill.llm.common import byte_chunks, fold, sigmoid, table

DIMS = 4096
#: Rows to fit on, of a language and in all: 6400 rows of 4096 single-precision numbers are 105 MB on the driver.
PER_LANGUAGE, MOST_ROWS = 800, 6400
UNKNOWN = "und"


def trigram_profile(text: str) -> np.ndarray:
    """Length-normalised square roots of the hashed byte-trigram counts."""
    counts = np.zeros(DIMS)
    for b in byte_chunks(" " + text.lower() + " ", overlap=2):
        b = b.astype(np.uint32)
        code = b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))
        counts += np.bincount((code * np.uint32(2654435761)) >> np.uint32(20), minlength=DIMS)
    counts = np.sqrt(counts)
    return (counts / max(float(np.sqrt((counts * counts).sum())), 1e-9)).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def profiles(texts) -> np.ndarray:
    return np.stack([trigram_profile(t) for t in texts]) if len(texts) else np.zeros((0, DIMS), np.float32)


def linear_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 120) -> np.ndarray:
    """Weights and bias minimising squared hinge + L2 by accelerated gradient steps; classes weigh the same."""
    # All in the type of x: weights of another would make a copy of x in every round.
    y = y.astype(x.dtype)
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(x.dtype)
    w = np.zeros(x.shape[1] + 1, dtype=x.dtype)
    ahead, step = w.copy(), x.dtype.type(1.0 / (4.0 + penalty))
    for i in range(rounds):
        slack = np.maximum(x.dtype.type(0), 1 - y * (x @ ahead[:-1] + ahead[-1]))
        pull = weight * slack * y
        grad = x.dtype.type(penalty) * ahead - 2 * np.append(pull @ x, pull.sum())
        new = ahead - step * grad
        ahead = new + x.dtype.type(i / (i + 3.0)) * (new - w)
        w = new
    return w


def one_versus_one(x: np.ndarray, y: np.ndarray, labels: list) -> dict:
    pairs = list(combinations(range(len(labels)), 2))
    rows = []
    for a, b in pairs:
        use = np.isin(y, [labels[a], labels[b]])
        rows.append(linear_svm(x if use.all() else x[use], np.where(y[use] == labels[a], 1.0, -1.0)))
    return {"labels": list(labels), "pairs": pairs, "w": np.array(rows, dtype=np.float32).reshape(len(pairs), DIMS + 1)}


def vote(model: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the winner and its least margin against the others (large if it has none)."""
    n, k = len(x), len(model["labels"])
    margins = np.full((n, k, k), np.inf)
    wins = np.zeros((n, k))
    totals = np.zeros((n, k))
    if model["pairs"]:
        m = x @ model["w"][:, :-1].T + model["w"][:, -1]
        for i, (a, b) in enumerate(model["pairs"]):
            margins[:, a, b], margins[:, b, a] = m[:, i], -m[:, i]
            wins[:, a] += m[:, i] > 0
            wins[:, b] += m[:, i] <= 0
            totals[:, a] += m[:, i]
            totals[:, b] -= m[:, i]
    best = np.argmax(wins + sigmoid(totals) * 0.5, axis=1)
    return best, margins[np.arange(n), best].min(axis=1, initial=np.inf)


def families(centroids: np.ndarray, count: int) -> list[list[int]]:
    """Average-linkage clusters by cosine."""
    unit = centroids / np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-9)
    near = unit @ unit.T
    groups = [[i] for i in range(len(centroids))]
    while len(groups) > count:
        i, j = max(combinations(range(len(groups)), 2), key=lambda p: near[np.ix_(groups[p[0]], groups[p[1]])].mean())
        groups[i] = groups[i] + groups.pop(j)
    return groups


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """The model; ``x`` is centred where it is."""
    languages = sorted(set(y))
    # What all texts have in common tells no language from another: profiles are centred.
    mean = np.mean([x[y == v].mean(axis=0) for v in languages], axis=0)
    x -= mean
    centroids = np.stack([x[y == v].mean(axis=0) for v in languages])
    groups = families(centroids, max(1, round(len(languages) ** 0.5)))
    family_of = {languages[i]: g for g, members in enumerate(groups) for i in members}
    top = one_versus_one(x, np.array([family_of[v] for v in y]), list(range(len(groups))))
    inner = []
    for members in groups:
        names = [languages[i] for i in sorted(members)]
        use = np.isin(y, names)
        inner.append(one_versus_one(x[use], y[use], names))
    return {"mean": mean.astype(np.float32), "top": top, "inner": inner}


def predict(model: dict, x: np.ndarray) -> tuple[list[str], np.ndarray]:
    x = x - model["mean"]
    family, margin = vote(model["top"], x)
    names, score = np.empty(len(x), dtype=object), sigmoid(4.0 * margin)
    for g, inner in enumerate(model["inner"]):
        if (at := np.flatnonzero(family == g)).size:
            best, margin = vote(inner, x[at])
            names[at] = [inner["labels"][b] for b in best]
            score[at] *= sigmoid(4.0 * margin)
    return list(names), score


def train_language_model(rows: DataFrame, per_language: int = PER_LANGUAGE, most_rows: int = MOST_ROWS) -> dict | None:
    """Fit on a sample of ``rows`` (doc_id, text, lang): about ``per_language`` of each language and ``most_rows`` in all, chosen by hash of the id."""
    usable = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("doc_id", "text", "lang")
    counts = {r["lang"]: r["n"] for r in rows.filter(F.col("lang").isNotNull()).groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    per_language = min(per_language, most_rows / len(counts))
    share = F.create_map(*[F.lit(v) for k, n in sorted(counts.items()) for v in (k, min(1.0, per_language / n))])[F.col("lang")]
    chosen = usable.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) < share * (1 << 30))

    def featurise(batches):
        for pdf in batches:
            yield pd.DataFrame({"lang": pdf["lang"], "x": [trigram_profile(t).astype(np.float16).tobytes() for t in pdf["text"]]})

    got = sorted(chosen.mapInPandas(featurise, "lang string, x binary").collect(), key=lambda r: (r["lang"], bytes(r["x"])))
    if not got:
        return None
    x, y = np.empty((len(got), DIMS), dtype=np.float32), np.array([r["lang"] for r in got], dtype=object)
    for i, r in enumerate(got):
        x[i] = np.frombuffer(r["x"], dtype=np.float16)
    del got
    return fit(x, y)


def language_column(model: dict | None):
    """A UDF from a text to (lang_pred, score)."""

    @F.pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if has_letter(t)] if model else []
            for at in range(0, len(known), 256):
                part = known[at : at + 256]
                found, score = predict(model, profiles([texts.iat[i] for i in part]))
                for i, name, s in zip(part, found, score):
                    names[i], scores[i] = name, float(s)
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return predicted


def identify_language(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every row."""
    return docs.select(F.col(id_col).alias("doc_id"), language_column(model)(F.col(text_col)).alias("found")).select("doc_id", "found.*")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict the language of every document; a quarter, by crc32 of the id, is held out of training."""
    docs = table(spark, sf_dir, "documents")
    model = train_language_model(docs.filter(fold("doc_id", 4) != 2))
    return identify_language(docs, model).select(
        "doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
