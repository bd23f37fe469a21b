"""The corpus pipeline against a brute-force version of its stages."""

import base64
import re

import corpus_pipeline as CP
import pyarrow.parquet as pq
import public_tokenizers as P
import tiktoken
from llm_data import awkward, documents
from test_simhash import slow_components, slow_fingerprint

from batchgate.llm import mixing, quality

SF = "/root/testdata/sf0.001"


def test_run_against_brute_force(spark):
    got = CP.run(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # Quality: the learned score itself is tested elsewhere; here its decision must take effect.
    from pyspark.sql import functions as F
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), allowed=F.crc32(F.col("id").cast("string")) % 5 != 0)
    good = {r["id"] for r in quality.score(docs, model).where("predicted = 1").collect()}
    table = pq.read_table(f"{SF}/documents.parquet").to_pandas()
    rows = [r for r in table.itertuples() if r.doc_id in good]
    groups = {}
    for r in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text or ""), []).append(r)
    rows = [min(g, key=lambda r: (-len(r.text or ""), r.doc_id)) for g in groups.values()]
    component = slow_components([r.doc_id for r in rows], [slow_fingerprint(r.text) for r in rows])
    rows = [r for r, c in zip(rows, component) if r.doc_id == c]
    left = docs.where(F.col("doc_id").isin([r.doc_id for r in rows]))
    copies = {r["id"]: r["copies"] for r in mixing.mix(left).collect()}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(CP.VOCABULARY), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((r.doc_id, tuple(library.encode_ordinary(r.text or ""))) for r in rows for _ in range(copies[r.doc_id]))
    assert sorted((r.doc_id, tuple(r.ids)) for r in got.itertuples()) == want
    assert got.round_trip.all() and 0 < len(good) < len(table)


def test_stages_take_awkward_rows(spark, tmp_path):
    rows = awkward()
    labels = spark.createDataFrame([(20 + i, 1, 0) for i in range(10)] + [(1, 0, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    sf = f"file:{tmp_path}"
    documents(spark, rows, clash=False).write.parquet(f"{sf}/documents.parquet")
    labels.write.parquet(f"{sf}/labels.parquet")
    for name, stage in CP.STAGES[:-1]:
        docs = documents(spark, rows)
        assert stage(spark, docs, sf).columns == docs.columns, name
        assert stage(spark, docs.limit(0), sf).count() == 0, name
    assert CP.run(spark, sf).where("NOT round_trip").count() == 0


def test_stages_are_the_five():
    assert [n for n, _ in CP.STAGES] == ["quality", "exact_dedup", "simhash_near_dedup", "mixing", "bpe"]


def test_near_copies_without_ids_are_told_apart(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(5, text), (None, text.upper()), (None, text.title()), (None, "quite another text of its own, without a copy"), (8, text + "\n")]
    out = CP.drop_near(spark, documents(spark, rows), "").collect()
    assert sorted((r["doc_id"] or -1, r["text"][:5]) for r in out) == [(-1, "quite"), (5, "word0")]
    none = [(None, text.upper()), (None, text.title()), (None, text)]
    assert CP.drop_near(spark, documents(spark, none), "").count() == 1


def test_mix_of_rows_without_ids(spark):
    rows = [(None if i % 3 else i // 6, f"text number {i} of some", "en", "ab"[i % 2]) for i in range(60)]
    out = CP.mix_sources(spark, documents(spark, rows), "").groupBy("text").count().collect()
    assert max(r["count"] for r in out) <= 2 and {r["text"] for r in out} <= {r[1] for r in rows}
    assert abs(sum(r["count"] for r in out) - 90) <= 3
