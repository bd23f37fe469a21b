"""Quality classifier by Bradley-Terry pairwise ranking.

Labelled documents give preference pairs (a label-1 document is preferred to a
label-0 one). The Bradley-Terry model with scores linear in document features,
P(i over j) = sigmoid(w . (f_i - f_j)), is the logistic loss on feature
differences, over at most ``max_pairs`` pairs drawn with replacement; Newton
steps learn w. The threshold is a quantile of the learned
document scores, the one that parts the labelled documents best, and the
reported score is sigmoid(s - s_quantile + logit(cut)), so that a document is
predicted 1 exactly when its Bradley-Terry score reaches that quantile.

Features are shares and ratios of the whole text; ids, labels, languages and
sources are no inputs. Learning uses at most ``max_labelled`` labelled rows
(by hash of the id, so reruns agree); scoring reads every row in full.

Defined results
  * NULL text scores like empty text; NULL labels are not learned from; repeated
    label rows count as often as they occur; a document id that repeats teaches once
    (the least of its features), so what is collected is bounded by ``max_labelled``.
  * Without rows of both labels there is nothing to learn: every score is 0.5.
  * Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import shipped

CUT = 0.3
MAX_LABELLED = 20_000
MAX_PAIRS = 100_000
RIDGE = 1e-3
_LOWER, _UPPER, _DIGIT = b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
_SPACE, _STOP, _MARKS = b" \t\n\x0b\x0c\r", b".,;:'\"()-?", b"!#$%&*+/<=>@[\\]^_`{|}~"
_CLASSES = (_LOWER, _UPPER, _DIGIT, _SPACE, _STOP, _MARKS)


def features(text: bytes | None) -> list[float]:
    """Character-class shares, word shapes and repetition of one whole text."""
    text = text or b""
    n = len(text)
    left = [n - len(text.translate(None, c)) for c in _CLASSES]
    share = [c / n if n else 0.0 for c in left]
    words = text.split()
    w = len(words)
    distinct = len(set(words))
    lines = text.count(b"\n") + 1
    marked = sum(1 for x in words if x[-1] in _MARKS) if left[5] else 0
    shout = sum(1 for x in words if x.isupper()) if left[1] else 0
    common = math.log((distinct + 1) / (w + 1))
    return [*share, 1 - sum(share), *[math.sqrt(s) for s in share[1:]], math.log1p(n), math.log1p(w), n / w if w else 0.0,
            marked / w if w else 0.0, shout / w if w else 0.0, common, common / math.log(w + 2), math.log1p(w / lines),
            1.0 if not w else 0.0]


def _features_udf() -> Callable:
    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([features(x) for x in texts])
    return run


def train(pos: np.ndarray, neg: np.ndarray, max_pairs: int = MAX_PAIRS, seed: int = 5) -> dict:
    """Bradley-Terry weights from preference pairs, and the quantile threshold."""
    rows = np.concatenate([pos, neg])
    mean, std = rows.mean(axis=0), rows.std(axis=0)
    std[std < 1e-9] = 1.0
    p, q = (pos - mean) / std, (neg - mean) / std
    draw = np.random.default_rng(seed)
    n = min(max_pairs, 20 * max(len(p), len(q)))
    diff = p[draw.integers(len(p), size=n)] - q[draw.integers(len(q), size=n)]
    w = np.zeros(diff.shape[1])
    for _ in range(60):
        loss_p = 1 / (1 + np.exp(np.clip(diff @ w, -500, 500)))
        grad = RIDGE * w - diff.T @ loss_p / n
        hess = (diff * (loss_p * (1 - loss_p))[:, None]).T @ diff / n + RIDGE * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-8:
            break
    scores, truth = np.concatenate([p @ w, q @ w]), np.repeat([1, 0], [len(p), len(q)])
    order = np.argsort(scores, kind="stable")
    s, t = scores[order], truth[order]
    # Quantile k: the k lowest scores are rejected. Balanced accuracy over all quantiles.
    right = np.concatenate([[0], np.cumsum(1 - t)]) / len(q) + (len(p) - np.concatenate([[0], np.cumsum(t)])) / len(p)
    same = np.concatenate([[False], s[1:] <= s[:-1], [False]])
    k = int(np.argmax(np.where(same, -1.0, right)))
    low, high = s[max(0, k - 1)], s[min(k, len(s) - 1)]
    return {"w": w / std, "mean": mean, "quantile": k / len(s), "threshold": float((low + high) / 2)}


def score_of(f: np.ndarray, model: dict | None, cut: float = CUT) -> np.ndarray:
    if model is None:
        return np.full(len(f), 0.5)
    z = (f - model["mean"]) @ model["w"] - model["threshold"] + math.log(cut / (1 - cut))
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_labelled: int = MAX_LABELLED, max_pairs: int = MAX_PAIRS) -> dict | None:
    """The model learned from at most ``max_labelled`` labelled rows (``allowed``: a
    condition on the column ``id``) and ``max_pairs`` pairs of them."""
    shipped(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    if allowed is not None:
        known = known.where(allowed)
    known = known.orderBy(F.xxhash64("id"), "id", "label").limit(max_labelled)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    # The labelled rows are at most max_labelled, so they may be broadcast.
    taught = texts.join(F.broadcast(known.select("id").distinct()), "id", "left_semi").select("id", _features_udf()("text").alias("f"))
    taught = taught.groupBy("id").agg(F.min("f").alias("f"))
    rows = taught.join(F.broadcast(known), "id").select("id", "label", "f").toPandas().sort_values(["id", "label"])
    if rows["label"].nunique() < 2:
        return None
    f = np.stack(rows["f"].to_numpy())
    return train(f[rows["label"] == 1], f[rows["label"] == 0], max_pairs)


def scorer(model: dict | None, cut: float = CUT) -> Callable:
    """Pandas UDF: binary text -> score."""
    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        out = [score_of(np.array([features(x) for x in texts[i:i + 256]]).reshape(-1, _WIDTH), model, cut)
               for i in range(0, len(texts), 256)]
        return pd.Series(np.concatenate(out) if out else np.empty(0))
    return run


_WIDTH = len(features(b""))


def score(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """id, score, predicted of every row."""
    shipped(docs.sparkSession)
    out = docs.select(F.col(id_col).alias("id"), scorer(model, cut)(F.col(text_col).cast("binary")).alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= cut, 1).otherwise(0))
