"""Quality rules learned as gradient-boosted trees over document statistics.

Base rules come first: a text with fewer than ``min_words`` words, or with more
than ``max_repeat`` percent of its words in 5-word windows that the text holds
twice or more, fails. The rest is judged by boosted trees over statistics of the
whole text (:data:`FEATURES`). Trees are grown with numpy on histograms of the
labelled rows (logistic loss, second-order gains). Features of :data:`MONOTONE` may
only push the score down as they rise: a split that breaks the direction is not
taken, and the values of its two sides bound everything below them, so the whole sum is
monotonic. For scoring, all trees are flattened into arrays of
nodes (feature, threshold, left, right, value), through which a batch of rows
walks one level at a time.

Learning uses at most ``max_labelled`` labelled rows (20,000 by default, the first
by a hash of the id); every statistic and every score is of all rows and whole texts.

Defined results
  * NULL text counts as empty: no words, fails the base rules.
  * Words are what the six ASCII white-space characters part; lines are parted by
    line feeds, compared exactly, and blank lines are no lines.
  * NULL labels are not learned from. Without rows of both labels there is no
    model: score is NULL and the base rules alone decide.
  * Repeated rows and ids are judged as often as they occur; empty tables give
    empty results; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchgate.llm.common import SPACES, shipped

MAX_LABELLED = 20_000
MIN_WORDS = 10
MAX_REPEAT = 20                     # percent
CUT = 0.5
WINDOW = 5
SYMBOLS = "#*$%&|<>"                # fixed value
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "stop_share",
            "shout_share", "other_share", "distinct_share", "words_a_line"]
#: Features that may only lower the score as they rise.
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "shout_share": -1}
SLICE = 2048


# ---------------------------------------------------------------- statistics

def repeated_words(codes: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more, the first occurrence included."""
    n, k, grams = len(codes), 1, codes
    while k < window:                       # number windows of k + step words by the numbers of their two parts
        step = min(k, window - k)
        if n < k + step:
            return 0
        values, grams = np.unique(grams[:n - k - step + 1].astype(np.int64) * (n + 1) + grams[step:], return_inverse=True)
        k += step
        if len(values) == len(grams):
            return 0
    again = np.flatnonzero(np.bincount(grams)[grams] > 1)
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, again, 1)
    np.add.at(change, again + window, -1)
    return int(np.count_nonzero(np.cumsum(change)))


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The counts (:data:`COUNTS`) and features (:data:`FEATURES`) of one whole text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()                     # bytes: the six white-space bytes only
    numbers: dict[bytes, int] = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    dup = len(lines) - len(set(lines))
    repeat = repeated_words(codes) if n > len(numbers) else 0
    size = max(1, len(raw))
    letters = [len(raw) - len(raw.translate(None, c)) for c in (_UPPER, _DIGIT, _STOP, b"!?", _OTHER)]
    features = [math.log1p(n), chars / n if n else 0.0, symbols / max(1, chars), dup / max(1, len(lines)), repeat / max(1, n),
                *[x / size for x in letters], len(numbers) / max(1, n), math.log1p(n / max(1, len(lines)))]
    return [n, chars, symbols, dup, repeat], features


_UPPER, _DIGIT, _STOP, _OTHER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:'\"()-", b"+/=@[\\]^_`{}~"


# ------------------------------------------------------------ boosted trees

def train(x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64,
          ridge: float = 1.0, least: float = 1.0) -> dict:
    """Boosted trees on rows x (features) and labels y (0 / 1), flattened to node arrays.

    ``signs``: +1 / -1 where the score may only rise / fall with the feature, else 0."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    base = math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    margin = np.full(len(y), base)
    nodes: list[list[float]] = []           # feature, threshold, left, right, value
    roots = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        roots.append(_grow(nodes, np.arange(len(y)), binned, cuts, grad, hess, signs, depth, ridge, least, -np.inf, np.inf, margin, rate))
    flat = np.array(nodes)
    return {"base": base, "depth": depth, "roots": np.array(roots), "feature": flat[:, 0].astype(np.int64), "threshold": flat[:, 1],
            "left": flat[:, 2].astype(np.int64), "right": flat[:, 3].astype(np.int64), "value": flat[:, 4]}


def _grow(nodes, rows, binned, cuts, grad, hess, signs, depth, ridge, least, low, high, margin, rate) -> int:
    """Adds the tree of ``rows`` whose leaf values stay within [low, high]; returns its node number."""
    at = len(nodes)
    g, h = grad[rows].sum(), hess[rows].sum()
    value = float(np.clip(-g / (h + ridge), low, high))
    nodes.append([0, np.inf, at, at, rate * value])                  # a leaf leads to itself
    split = _split(rows, binned, cuts, grad, hess, signs, ridge, least, low, high) if depth and len(rows) > 1 else None
    if split is None:
        margin[rows] += rate * value
        return at
    j, b, left_value, right_value = split
    goes = binned[rows, j] <= b
    mid = (left_value + right_value) / 2
    bounds = {0: ((low, high), (low, high)), 1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid))}[signs[j]]
    kids = [_grow(nodes, part, binned, cuts, grad, hess, signs, depth - 1, ridge, least, *bound, margin, rate)
            for part, bound in zip((rows[goes], rows[~goes]), bounds)]
    nodes[at] = [j, cuts[j][b], *kids, 0.0]
    return at


def _split(rows, binned, cuts, grad, hess, signs, ridge, least, low, high) -> tuple[int, int, float, float] | None:
    """The best allowed split: feature, last bin of the left side, values of both sides."""
    def gain(value, g, h):                                            # loss that this value saves
        return -(g * value + (h + ridge) * value * value / 2)

    g, h = grad[rows].sum(), hess[rows].sum()
    best, most = None, gain(np.clip(-g / (h + ridge), low, high), g, h) + 1e-9
    for j, c in enumerate(cuts):
        if not len(c):
            continue
        b = binned[rows, j]
        gl = np.cumsum(np.bincount(b, weights=grad[rows], minlength=len(c) + 1))[:-1]
        hl = np.cumsum(np.bincount(b, weights=hess[rows], minlength=len(c) + 1))[:-1]
        vl, vr = (np.clip(-gg / (hh + ridge), low, high) for gg, hh in ((gl, hl), (g - gl, h - hl)))
        total = gain(vl, gl, hl) + gain(vr, g - gl, h - hl)
        allowed = (hl >= least) & (h - hl >= least) & (signs[j] * (vr - vl) >= 0)
        total = np.where(allowed, total, -np.inf)
        k = int(np.argmax(total))
        if total[k] > most:
            best, most = (j, k, float(vl[k]), float(vr[k])), total[k]
    return best


def score_of(x: np.ndarray, model: dict) -> np.ndarray:
    """Probabilities of label 1: all rows walk all trees together, one level a step."""
    node = np.broadcast_to(model["roots"], (len(x), len(model["roots"])))
    row = np.arange(len(x))[:, None]
    for _ in range(model["depth"]):
        node = np.where(x[row, model["feature"][node]] <= model["threshold"][node], model["left"][node], model["right"][node])
    return 1 / (1 + np.exp(-(model["base"] + model["value"][node].sum(axis=1))))


# ------------------------------------------------------------------ operator

def _frame(rows: DataFrame, model: dict | None, with_features: bool) -> DataFrame:
    """Statistics, and score or features, of the rows' column ``text``; the first column goes along."""
    shipped(rows.sparkSession)
    fields = [T.StructField(rows.columns[0], rows.schema[0].dataType)] + [T.StructField(c, T.LongType()) for c in COUNTS]
    fields.append(T.StructField("features", T.ArrayType(T.DoubleType())) if with_features else T.StructField("score", T.DoubleType()))
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                counts, features = zip(*[statistics(t.as_py()) for t in part.column(1)])
                if with_features:
                    last = pa.array(features, pa.list_(pa.float64()))
                else:
                    last = pa.array(score_of(np.array(features), model) if model else [None] * len(counts), pa.float64())
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, pa.int64()) for c in zip(*counts)], last], names=names)

    return rows.mapInArrow(run, T.StructType(fields))


def fit(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> dict | None:
    """Trees learned from at most ``max_labelled`` labelled documents (``allowed``: a condition on the column ``id``)."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    if allowed is not None:
        known = known.where(allowed)
    known = known.orderBy(F.xxhash64("id"), "id", "label").limit(max_labelled)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # The labels are at most max_labelled rows, so they may be broadcast; a labelled id that many rows share
    # is bounded by the second limit.
    rows = texts.join(F.broadcast(known), "id").select(F.struct("id", "label").alias("key"), "text")
    found = _frame(rows, None, True).orderBy(F.xxhash64("key.id"), "key.id", "key.label", "features").limit(max_labelled)
    got = found.select("key.label", "features").collect()
    y = np.array([float(r["label"]) for r in got])
    if len(set(y.tolist())) < 2:
        return None
    return train(np.array([r["features"] for r in got]), y, [MONOTONE.get(f, 0) for f in FEATURES])


def judge(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
          max_repeat: int = MAX_REPEAT, cut: float = CUT) -> DataFrame:
    """id, the counts, score, base_failed and kept of every row."""
    out = _frame(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), model, False)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & F.coalesce(F.col("score") >= cut, F.lit(True)))
