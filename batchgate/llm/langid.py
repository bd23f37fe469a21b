"""Language identification with a bidirectional gated recurrent network over bytes.

The network is written and trained here in numpy by backpropagation through
time: a forward and a backward GRU read windows of bytes, a softmax layer on
both states labels every position, and a document's probabilities are the mean
over all its positions. Training uses a bounded sample of labelled windows
(``max_docs`` documents, one window each, by hash of the id, evenly over the
languages); prediction reads every byte of every text.

Long texts are cut into windows of ``WINDOW`` bytes that are processed in
lockstep. The last window of a text ends at its end and overlaps the one
before; overlapping positions count once.

Defined results
  * NULL text, and text without a letter, is ``und`` with score 0. So is every
    text if there is no labelled row to learn from.
  * NULL labels are not learned from. Repeated rows get equal results; empty
    tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchgate.llm.common import shipped, written

WINDOW = 128
HIDDEN = 12
MAX_DOCS = 4000
TRAIN_CHARS = 96
STEPS = 160
BATCH = 256
BLOCK = 4096


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def init(classes: int, hidden: int = HIDDEN, seed: int = 3) -> dict[str, np.ndarray]:
    """Weights of both directions; ``x*`` holds the input projection of every byte."""
    draw = np.random.default_rng(seed)
    out = {"o": draw.normal(0, 0.2, (2 * hidden, classes)), "c": np.zeros(classes)}
    for d in "fb":
        out["x" + d] = draw.normal(0, 0.3, (256, 3 * hidden))
        out["u" + d] = draw.normal(0, hidden ** -0.5, (hidden, 3 * hidden))
    return {k: v.astype(np.float32) for k, v in out.items()}


def _gru(bytes_: np.ndarray, mask: np.ndarray | None, x: np.ndarray, u: np.ndarray, back: bool, tape: list | None = None) -> Iterator:
    """Hidden states of one direction, position by position (bytes_: window x position)."""
    hidden = len(u)
    h = np.zeros((len(bytes_), hidden), np.float32)
    for t in reversed(range(bytes_.shape[1])) if back else range(bytes_.shape[1]):
        xi = x[bytes_[:, t]]
        g = h @ u
        gates = _sigmoid(xi[:, :2 * hidden] + g[:, :2 * hidden])
        z, r = gates[:, :hidden], gates[:, hidden:]
        n = np.tanh(xi[:, 2 * hidden:] + r * g[:, 2 * hidden:])
        new = n + z * (h - n)
        if mask is not None:
            new *= mask[:, t:t + 1]
        if tape is not None:
            tape.append((t, h, z, r, n, g[:, 2 * hidden:]))
        h = new
        yield t, h


def position_probabilities(bytes_: np.ndarray, mask: np.ndarray | None, p: dict[str, np.ndarray]) -> np.ndarray:
    """Class probabilities of every position: (positions, windows, classes)."""
    hidden = len(p["uf"])
    logits = np.empty((bytes_.shape[1], len(bytes_), len(p["c"])), np.float32)
    for t, h in _gru(bytes_, mask, p["xf"], p["uf"], False):
        logits[t] = h @ p["o"][:hidden] + p["c"]
    for t, h in _gru(bytes_, mask, p["xb"], p["ub"], True):
        logits[t] += h @ p["o"][hidden:]
        logits[t] -= logits[t].max(axis=1, keepdims=True)
        np.exp(logits[t], out=logits[t])
        logits[t] /= logits[t].sum(axis=1, keepdims=True)
    return logits


def gradients(bytes_: np.ndarray, mask: np.ndarray, label: np.ndarray, p: dict[str, np.ndarray]) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over all positions, and its gradients by backpropagation through time."""
    hidden, classes = len(p["uf"]), len(p["c"])
    n, length = bytes_.shape
    tapes: dict[str, list] = {"f": [], "b": []}
    states = {d: np.empty((length, n, hidden), np.float32) for d in "fb"}
    for d in "fb":
        for t, h in _gru(bytes_, mask, p["x" + d], p["u" + d], d == "b", tapes[d]):
            states[d][t] = h
    both = np.concatenate([states["f"], states["b"]], axis=2)
    logits = both @ p["o"] + p["c"]
    logits -= logits.max(axis=2, keepdims=True)
    prob = np.exp(logits)
    prob /= prob.sum(axis=2, keepdims=True)
    weight = mask.T / mask.sum()
    loss = float(-(np.log(prob[:, np.arange(n), label] + 1e-12) * weight).sum())
    d_logits = prob
    d_logits[:, np.arange(n), label] -= 1
    d_logits *= weight[..., None]
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    grad["o"] = both.reshape(-1, 2 * hidden).T @ d_logits.reshape(-1, classes)
    grad["c"] = d_logits.sum(axis=(0, 1))
    d_both = d_logits @ p["o"].T
    for k, d in enumerate("fb"):
        u, carry = p["u" + d], np.zeros((n, hidden), np.float32)
        for t, h, z, r, cand, gn in reversed(tapes[d]):
            dh = (d_both[t][:, k * hidden:(k + 1) * hidden] + carry) * mask[:, t:t + 1]
            dn = dh * (1 - z) * (1 - cand * cand)
            dz = dh * (h - cand) * z * (1 - z)
            dr = dn * gn * r * (1 - r)
            dx = np.concatenate([dz, dr, dn], axis=1)
            dg = np.concatenate([dz, dr, dn * r], axis=1)
            grad["u" + d] += h.T @ dg
            np.add.at(grad["x" + d], bytes_[:, t], dx)
            carry = dh * z + dg @ u.T
    return loss, grad


def _padded(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    out, mask = np.zeros((len(texts), width), np.uint8), np.zeros((len(texts), width), np.float32)
    for i, x in enumerate(texts):
        x = x[:width]
        out[i, :len(x)] = np.frombuffer(x, np.uint8)
        mask[i, :len(x)] = 1
    return out, mask


def train(texts: list[bytes], labels: list[str], hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH,
          width: int = TRAIN_CHARS, seed: int = 3) -> dict | None:
    """Adam over mini-batches of windows; returns the weights and the label names."""
    names = sorted(set(labels))
    if not names:
        return None
    p = init(len(names), hidden, seed)
    if len(names) > 1:
        data, mask = _padded(texts, width)
        y = np.array([names.index(x) for x in labels])
        draw = np.random.default_rng(seed)
        m1 = {k: np.zeros_like(v) for k, v in p.items()}
        m2 = {k: np.zeros_like(v) for k, v in p.items()}
        for step in range(1, steps + 1):
            at = draw.integers(len(y), size=batch)
            _, grad = gradients(data[at], mask[at], y[at], p)
            rate = 0.02 * min(1.0, 2.0 * (1 - (step - 1) / steps))
            for k in p:
                g = np.clip(grad[k], -1, 1)
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.99 * m2[k] + 0.01 * g * g
                p[k] -= (rate * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return {"names": names, "p": p}


def fit(docs: DataFrame, allowed: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_docs: int = MAX_DOCS, chars: int = TRAIN_CHARS) -> dict | None:
    """The network learned from at most ``max_docs`` windows of labelled rows
    (``allowed``: a condition on the column ``id``), as many of each language."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where("lang IS NOT NULL")
    if allowed is not None:
        rows = rows.where(allowed)
    # The languages with most rows, at most max_docs of them (one window each): few enough to broadcast.
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(max_docs)
    counts = written(counts, "langid_counts")
    each = max(1, max_docs // max(1, counts.count()))
    h, text = F.xxhash64("id"), F.col("text")
    start = 1 + F.pmod(F.xxhash64("id", F.lit(1)), F.greatest(F.lit(1), F.length("text") - chars))
    # Rows of a language are thinned by their hash to about three times what is wanted
    # before the window sees them.
    place = F.pmod(h, F.lit(1 << 30))
    rows = (rows.join(F.broadcast(counts), "lang").where(place < F.least(F.lit(1.0), F.lit(3.0 * each) / F.col("n")) * (1 << 30))
                .where(text.rlike(r"\p{L}"))
                .select("lang", place.alias("h"), F.substring(text, start.cast("int"), F.lit(chars)).cast("binary").alias("x")))
    ranked = rows.withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy("h", "x"))).where(F.col("k") <= each)
    got = ranked.orderBy("lang", "h", "x").select("x", "lang").limit(max_docs).collect()
    return train([bytes(r.x) for r in got], [r.lang for r in got])


def document_probabilities(texts: list[bytes], model: dict, block: int = BLOCK) -> np.ndarray:
    """Mean position probabilities of every text (texts x classes), all bytes read."""
    p, classes = model["p"], len(model["names"])
    total, length = np.zeros((len(texts), classes)), np.array([len(x) for x in texts])
    jobs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    data = np.frombuffer(b"".join(texts), np.uint8)
    offset = np.concatenate([[0], np.cumsum(length)])[:-1]
    long = np.flatnonzero(length >= WINDOW)
    counts = -(-length[long] // WINDOW)
    doc = np.repeat(long, counts)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = np.minimum(nth * WINDOW, length[doc] - WINDOW)             # the last window ends with the text
    skip = nth * WINDOW - first                                         # its positions that were counted before
    span = np.arange(WINDOW)
    for i in range(0, len(doc), block):
        d = doc[i:i + block]
        windows = data[(offset[d] + first[i:i + block])[:, None] + span]
        prob = position_probabilities(windows, None, p)
        keep = (span[:, None] >= skip[i:i + block]).astype(np.float32)
        np.add.at(total, d, np.einsum("lnc,ln->nc", prob, keep))
    short = np.flatnonzero((length < WINDOW) & (length > 0))
    short = short[np.argsort(length[short], kind="stable")]             # windows of like length go together
    for i in range(0, len(short), block):
        d = short[i:i + block]
        windows, mask = _padded([texts[k] for k in d], int(length[d].max()))
        total[d] += np.einsum("lnc,nl->nc", position_probabilities(windows, mask, p), mask)
    return total / np.maximum(1, length)[:, None]


def predict(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = 8 << 20) -> DataFrame:
    """id, lang_pred, score of every row."""
    shipped(docs.sparkSession)
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.when(text.rlike(r"\p{L}"), text.cast("binary")).alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def labelled(ids: pa.Array, texts: list) -> pa.RecordBatch:
            lang, value = ["und"] * len(texts), np.zeros(len(texts))
            known = [i for i, x in enumerate(texts) if x is not None]
            if model is not None and known:
                prob = document_probabilities([texts[i] for i in known], model)
                for i, row in zip(known, prob):
                    lang[i], value[i] = model["names"][int(row.argmax())], float(row.max())
            return pa.RecordBatch.from_arrays([ids, pa.array(lang), pa.array(np.clip(value, 0, 1))], names=["id", "lang_pred", "score"])

        for batch in batches:
            start, size, texts = 0, 0, []
            for i, x in enumerate(batch.column(1)):
                texts.append(x.as_py())
                size += len(texts[-1] or b"")
                if size >= slice_bytes:
                    yield labelled(batch.column(0).slice(start, len(texts)), texts)
                    start, size, texts = i + 1, 0, []
            if texts:
                yield labelled(batch.column(0).slice(start, len(texts)), texts)

    return rows.mapInArrow(run, schema)
