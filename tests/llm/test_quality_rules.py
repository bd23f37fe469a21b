"""Boosted quality rules: counts against brute force, held-out labels, monotonic scores, edge cases."""

import random
import re

import numpy as np
import pyarrow.parquet as pq
from llm_data import awkward, documents, words
from pyspark.sql import functions as F

from batchgate.llm import quality_rules as Q
from batchgate.llm.queries import op12_quality_rules

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    seen = {}
    for x in windows:
        seen[x] = seen.get(x, 0) + 1
    covered = {i + k for i, x in enumerate(windows) if seen[x] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def walk(model, x):
    """One row through the trees, node by node."""
    total = model["base"]
    for at in model["roots"]:
        while model["left"][at] != at:
            at = model["left"][at] if x[model["feature"][at]] <= model["threshold"][at] else model["right"][at]
        total += model["value"][at]
    return 1 / (1 + np.exp(-total))


def test_query_counts_and_held_out_labels(spark):
    got = {r["doc_id"]: r for r in op12_quality_rules(spark, SF).collect()}
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        n, _, _, _, repeat = want = brute(text)
        assert tuple(got[i][c] for c in Q.COUNTS) == want
        assert got[i]["base_failed"] == (n < 10 or 100 * repeat > 20 * n)
        assert got[i]["kept"] == (not got[i]["base_failed"] and got[i]["score"] >= Q.CUT)
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    held = [(got[i]["score"] >= Q.CUT, q == 1) for i, q in labels.items() if got[i]["held_out"]]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.96


def sample(seed=2, n=3000):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 4))
    noisy = 3 * x[:, 0] - 2 * x[:, 1] + 2 * np.sin(9 * x[:, 2]) + rng.normal(0, 0.7, n)
    return x, (noisy > 0.5).astype(float)


def test_trees_learn_and_flat_arrays_equal_a_walk():
    x, y = sample()
    model = Q.train(x, y, [0, 0, 0, 0])
    p = Q.score_of(x, model)
    assert ((p > 0.5) == (y == 1)).mean() > 0.85
    assert np.allclose(p[:200], [walk(model, r) for r in x[:200]])


def test_constraints_hold_everywhere():
    x, y = sample()
    for signs in ([1, -1, 0, 0], [-1, 1, 1, 0], [0, 0, -1, 1]):
        model = Q.train(x, y, signs, depth=4)
        at = np.random.default_rng(7).random((300, 4))
        for j, sign in enumerate(signs):
            path = np.repeat(at[:, None, :], 41, axis=1)
            path[:, :, j] = np.linspace(-0.1, 1.1, 41)
            p = Q.score_of(path.reshape(-1, 4), model).reshape(300, 41)
            assert sign == 0 or (sign * np.diff(p, axis=1) >= 0).all()
    assert Q.score_of(x, Q.train(x, y, [0, 0, 0, 0])).std() > 0.2      # without constraints: not flat


def test_more_symbols_never_raise_a_score(spark):
    docs, labels = make(spark)
    model = Q.fit(docs, labels)
    base = np.array([Q.statistics(words(random.Random(i), 60))[1] for i in range(20)])
    for name in Q.MONOTONE:
        rows = np.repeat(base[:, None, :], 30, axis=1)
        rows[:, :, Q.FEATURES.index(name)] = np.linspace(0, 1, 30)
        assert (np.diff(Q.score_of(rows.reshape(-1, len(Q.FEATURES)), model).reshape(20, 30), axis=1) <= 0).all()


def make(spark):
    rng = random.Random(1)
    rows = [(i, words(rng, 40) if i % 3 else " ".join(w + "$$$" for w in words(rng, 40).split())) for i in range(150)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), "x") for i in range(150)] + [(5, None, "x"), (None, 1, "x"), (999, 0, "x")],
                                   "doc_id long, quality int, text string")
    return documents(spark, rows), labels


def test_learns_from_text_alone(spark):
    docs, labels = make(spark)
    model = Q.fit(docs, labels, allowed=F.col("id") % 5 != 0)
    got = {r["id"]: r for r in Q.judge(docs, model).collect()}
    assert all(got[i]["kept"] == (i % 3 > 0) for i in range(150))
    other = docs.select((F.col("doc_id") + 7).alias("doc_id"), "text", F.lit("zz").alias("lang"))
    assert sorted(r["score"] for r in Q.judge(other, model).collect()) == sorted(r["score"] for r in got.values())


def test_a_labelled_id_on_many_rows_stays_bounded(spark, monkeypatch):
    docs, labels = make(spark)
    many = docs.unionByName(documents(spark, [(4, f"text {i}") for i in range(3000)]))
    seen = []
    monkeypatch.setattr(Q, "train", lambda x, y, signs: seen.append(len(x)))
    Q.fit(many, labels, max_labelled=100)
    assert seen == [100]


def test_awkward_rows_and_missing_labels(spark):
    docs, labels = make(spark)
    model = Q.fit(docs, labels)
    rows = awkward() + [(400, "a b c d e " * 30), (401, "\n".join(["one line here"] * 5 + ["", " ", "other\r"])), (402, "x y z " * 9)]
    got = Q.judge(documents(spark, rows), model).collect()
    assert sorted(tuple(r[c] for c in Q.COUNTS) for r in got) == sorted(brute(r[1]) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in got) and not any(r["kept"] for r in got if r["base_failed"])
    assert Q.fit(docs, labels.limit(0)) is None and Q.fit(docs.limit(0), labels) is None
    assert Q.fit(docs, labels.where("quality = 1")) is None
    assert all(r["score"] is None and r["kept"] != r["base_failed"] for r in Q.judge(docs, None).collect())
    assert Q.judge(docs.limit(0), model).count() == 0
