"""Language identification: gradients, held-out accuracy, edge cases."""

import numpy as np
import pyarrow.parquet as pq
from llm_data import awkward, documents
from pyspark.sql import functions as F

from batchgate.llm import langid

SF = "/root/testdata/sf0.01"


def test_gradients_by_differences():
    rng = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in langid.init(3, 4).items()}
    data = rng.integers(97, 102, (5, 7)).astype(np.uint8)
    mask = np.ones((5, 7))
    mask[0, 4:] = 0
    y = rng.integers(3, size=5)
    _, grad = langid.gradients(data, mask, y, p)
    for name in p:
        for at in list(zip(*np.nonzero(np.abs(grad[name]) > 1e-4)))[:6]:
            old, eps = p[name][at], 1e-4
            p[name][at] = old + eps
            up, _ = langid.gradients(data, mask, y, p)
            p[name][at] = old - eps
            down, _ = langid.gradients(data, mask, y, p)
            p[name][at] = old
            assert np.isclose((up - down) / (2 * eps), grad[name][at], rtol=0.02, atol=1e-4), name


def test_held_out_accuracy(spark):
    from batchgate.llm.queries import op10_language_id
    docs = pq.read_table(f"{SF}/documents.parquet").to_pandas()
    got = op10_language_id(spark, SF).toPandas().merge(docs, on="doc_id")
    held = got[got.held_out]
    assert len(held) > 100 and (held.lang == held.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_all_bytes_count_once_whatever_the_windows():
    model = {"names": ["a", "b"], "p": langid.init(2, 4)}
    rng = np.random.default_rng(2)
    texts = [rng.integers(32, 127, n).astype(np.uint8).tobytes() for n in (1, 5, 127, 128, 129, 300, 1000)] + [b""]
    together = langid.document_probabilities(texts, model, block=3)
    for i, t in enumerate(texts):
        alone = langid.document_probabilities([t], model)
        assert np.allclose(alone[0], together[i], atol=1e-5) and np.isclose(together[i].sum(), 1 if t else 0, atol=1e-4)


def test_awkward_rows(spark):
    rows = awkward()
    rows = [(i, t, "de" if k % 2 else None, s) for k, (i, t, _, s) in enumerate(rows)]
    docs = documents(spark, rows)
    model = langid.fit(docs, max_docs=50)
    assert model["names"] == ["de"]
    got = langid.predict(docs, model).collect()
    assert len(got) == len(rows) and {r["lang_pred"] for r in got} == {"de", "und"}
    texts = [t for _, t, *_ in rows]
    assert sum(r["lang_pred"] == "und" for r in got) == sum(not any(c.isalpha() for c in t or "") for t in texts)
    nothing = langid.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert nothing is None and {r["lang_pred"] for r in langid.predict(docs, nothing).collect()} == {"und"}
    assert langid.predict(docs.limit(0), model).count() == 0
