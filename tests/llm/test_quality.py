"""Bradley-Terry quality scores: held-out accuracy and edge cases."""

import random

import numpy as np
import pyarrow.parquet as pq
from llm_data import awkward, documents, words
from pyspark.sql import functions as F

from batchgate.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    from batchgate.llm.queries import op5_quality
    got = op5_quality(spark, SF).toPandas().merge(pq.read_table(f"{SF}/labels.parquet").to_pandas(), on="doc_id")
    held = got[got.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.97
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()


def make(spark):
    rng = random.Random(1)
    rows = [(i, words(rng, 40) if i % 3 else " ".join(w + "$$$" for w in words(rng, 40).split())) for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), "x") for i in range(120)] + [(5, None, "x"), (None, 1, "x"), (999, 0, "x")],
                                   "doc_id long, quality int, text string")
    return documents(spark, rows), labels


def test_learns_and_ignores_labels_language_and_ids(spark):
    docs, labels = make(spark)
    model = quality.fit(docs, labels, allowed=F.col("id") % 5 != 0)
    got = {r["id"]: r for r in quality.score(docs, model).collect()}
    assert all(got[i]["predicted"] == int(i % 3 > 0) for i in range(120))
    other = docs.select((F.col("doc_id") + 7).alias("doc_id"), "text", F.lit("zz").alias("lang"))
    assert sorted(r["score"] for r in quality.score(other, model).collect()) == sorted(r["score"] for r in got.values())


def test_awkward_rows_and_missing_labels(spark):
    docs, labels = make(spark)
    model = quality.fit(docs, labels)
    rows = awkward()
    got = quality.score(documents(spark, rows), model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert quality.fit(docs, labels.limit(0)) is None and quality.fit(docs.limit(0), labels) is None
    assert {r["score"] for r in quality.score(docs, None).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0


def test_the_threshold_is_a_score_quantile():
    rng = np.random.default_rng(1)
    model = quality.train(rng.normal(1, 1, (300, 3)), rng.normal(-1, 1, (100, 3)))
    assert 0.15 < model["quantile"] < 0.35
    scores = quality.score_of(np.array([[9, 9, 9], [-9, -9, -9.0]]), model)
    assert scores[0] > 0.9 and scores[1] < 0.1
