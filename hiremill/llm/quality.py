"""Quality by a generalised additive model with pairwise interactions.

Each document becomes a row of plain shape features (length, word and line
repetition, symbol shares, ...), computed over its whole text. Features are cut
into quantile bins. Cyclic boosting visits the features in turn, fits a shallow
tree (at most three leaves) to the residual over the bins and adds a fraction
of it to that feature's lookup table; then the pairs that explain most of the
remaining residual are boosted the same way with four-quadrant trees. A score is
the sigmoid of the sum of the looked-up bins: vectorised additions.

Labels other than 0 and 1, NULL ids and NULL labels teach nothing. NULL and
empty texts get the score of their (all zero) features. Without a training row
the score is 0.5 for all. Repeated rows are each scored; extra columns are
not read. Words are the pieces between white space.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiremill.llm.common import byte_chunks, fold, sample_by_hash, sigmoid, table

SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
BINS, GRID = 48, 12
FEATURES = (
    "log_bytes", "log_words", "mean_word", "upper", "symbols", "digits", "non_ascii", "new_lines", "exclaims", "commas",
    "stops", "distinct_words", "repeated_next", "distinct_lines", "mean_line", "byte_entropy", "symbol_ends", "distinct_ratio_log",
)

_CLASS = np.zeros(256, dtype=np.int64)
for _c in range(256):
    _ch = chr(_c)
    _CLASS[_c] = (
        6 if _c >= 128 else 1 if _ch.isupper() else 2 if _ch.islower() else 3 if _ch.isdigit() else 4 if _ch.isspace() else 5
    )
_SYMBOLS = set("!#$%&*+/<=>?@^_|~")


def text_features(text: str | None) -> np.ndarray:
    """One row of FEATURES; zeros for no text."""
    out = np.zeros(len(FEATURES))
    if not text:
        return out
    seen = np.zeros(256, dtype=np.int64)
    for b in byte_chunks(text):
        seen += np.bincount(b, minlength=256)
    size = int(seen.sum())
    kinds = np.bincount(_CLASS, weights=seen, minlength=7)
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n, letters = max(len(words), 1), max(kinds[1] + kinds[2], 1.0)
    part = seen[seen > 0] / size
    distinct = len(set(words))
    out[:] = (
        np.log1p(size), np.log1p(len(words)), (size - kinds[4]) / n, kinds[1] / letters, kinds[5] / size, kinds[3] / size, kinds[6] / size,
        seen[10] / n, seen[33] / n, seen[44] / n, seen[46] / n, distinct / n,
        sum(map(str.__eq__, words[1:], words[:-1])) / n, len(set(lines)) / max(len(lines), 1), np.log1p(size / max(len(lines), 1)),
        -(part * np.log2(part)).sum(), sum(w[-1] in _SYMBOLS for w in words) / n, np.log(max(distinct, 1)) / np.log(n + 1.0),
    )
    return out


def features_of(texts) -> np.ndarray:
    return np.stack([text_features(t) for t in texts]) if len(texts) else np.zeros((0, len(FEATURES)))


def _binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, i], side="right") for i, c in enumerate(cuts)], axis=1) if len(x) else np.zeros((0, len(cuts)), int)


def _tree(grad: np.ndarray, hess: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Leaf values over the bins of a greedy tree with at most so many leaves."""
    spans = [(0, len(grad))]
    fit = lambda g, h: g * g / (h + 1.0)
    while len(spans) < leaves:
        best = (1e-9, None)
        for k, (a, b) in enumerate(spans):
            g, h = np.cumsum(grad[a:b]), np.cumsum(hess[a:b])
            if b - a < 2:
                continue
            gain = fit(g[:-1], h[:-1]) + fit(g[-1] - g[:-1], h[-1] - h[:-1]) - fit(g[-1], h[-1])
            if (m := int(np.argmax(gain))) >= 0 and gain[m] > best[0]:
                best = (gain[m], (k, a + m + 1))
        if best[1] is None:
            break
        k, cut = best[1]
        a, b = spans.pop(k)
        spans += [(a, cut), (cut, b)]
    out = np.zeros(len(grad))
    for a, b in spans:
        out[a:b] = grad[a:b].sum() / (hess[a:b].sum() + 1.0)
    return out


def _quadrants(grad: np.ndarray, hess: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cross cut of a two-dimensional grid: its gain and the four leaf values over the grid."""
    g, h = grad.cumsum(0).cumsum(1), hess.cumsum(0).cumsum(1)

    def parts(c):
        ll, l_, _l = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1]
        return ll, l_ - ll, _l - ll, c[-1, -1] - l_ - _l + ll

    gain = sum(a * a / (b + 1.0) for a, b in zip(parts(g), parts(h)))
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.zeros(grad.shape)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for cols in (slice(0, j + 1), slice(j + 1, None)):
            out[rows, cols] = grad[rows, cols].sum() / (hess[rows, cols].sum() + 1.0)
    return float(gain[i, j]), out


def fit_gam(x: np.ndarray, y: np.ndarray, rounds: int = 150, pairs: int = 6, rate: float = 0.15) -> dict:
    """Lookup tables of every feature and of the chosen pairs."""
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) for i in range(width)]
    bins = _binned(x, cuts)
    base = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    z = np.full(n, np.log(base / (1 - base)))
    model = {"cuts": cuts, "bias": float(z[0]), "tables": [np.zeros(len(c) + 1) for c in cuts], "pairs": []}
    for _ in range(rounds):
        for i in range(width):
            p = sigmoid(z)
            grad = np.bincount(bins[:, i], weights=y - p, minlength=len(cuts[i]) + 1)
            hess = np.bincount(bins[:, i], weights=p * (1 - p), minlength=len(cuts[i]) + 1)
            add = rate * _tree(grad, hess)
            model["tables"][i] += add
            z += add[bins[:, i]]
    # Pairs: the coarse grids on which the residual that is left varies most.
    coarse = [np.minimum(np.arange(len(c) + 1) * GRID // (len(c) + 1), GRID - 1) for c in cuts]
    small = np.stack([coarse[i][bins[:, i]] for i in range(width)], axis=1)

    def grids(a, b):
        p = sigmoid(z)
        cell = small[:, a] * GRID + small[:, b]
        return (np.bincount(cell, weights=v, minlength=GRID * GRID).reshape(GRID, GRID) for v in (y - p, p * (1 - p)))

    ranked = sorted(combinations(range(width), 2), key=lambda q: -_quadrants(*grids(*q))[0])[:pairs]
    tables = {q: np.zeros((GRID, GRID)) for q in ranked}
    for _ in range(rounds // 3):
        for a, b in ranked:
            add = rate * _quadrants(*grids(a, b))[1]
            tables[a, b] += add
            z += add[small[:, a], small[:, b]]
    model["pairs"] = [(a, b, coarse[a], coarse[b], t) for (a, b), t in tables.items()]
    return model


def score_gam(model: dict | None, x: np.ndarray) -> np.ndarray:
    if model is None:
        return np.full(len(x), 0.5)
    bins = _binned(x, model["cuts"])
    z = np.full(len(x), model["bias"])
    for i, t in enumerate(model["tables"]):
        z += t[bins[:, i]]
    for a, b, ca, cb, t in model["pairs"]:
        z += t[ca[bins[:, a]], cb[bins[:, b]]]
    return sigmoid(z)


def _feature_rows(docs: DataFrame, extra: str) -> DataFrame:
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"y": pdf["y"], "x": list(features_of(pdf["text"]))})

    return docs.select("text", F.col(extra).cast("double").alias("y")).mapInPandas(run, "y double, x array<double>")


def train_quality_model(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict | None:
    """Fit on at most ``sample_rows`` labelled rows, those whose id has the smallest hash."""
    chosen = sample_by_hash(
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality"), "doc_id", sample_rows
    )
    # Proven bound: sample_rows rows of two numbers.
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    got = sorted(_feature_rows(joined, "quality").collect())
    y = np.array([r["y"] for r in got])
    return fit_gam(np.array([r["x"] for r in got]), y) if len(set(y)) == 2 else None


def quality_column(model: dict | None):
    """A UDF from a text to its score."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(score_gam(model, features_of(texts)))

    return scored


def score_quality(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    return docs.select(F.col(id_col).alias("doc_id"), quality_column(model)(F.col(text_col)).alias("score"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document; the fifth with crc32 remainder 0 is held out of training."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train_quality_model(docs, labels.filter(fold("doc_id", 5) != 0))
    return score_quality(docs, model).select(
        "doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
