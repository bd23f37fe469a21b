"""A corpus pipeline over ``documents``: quality classifier, exact dedup, SimHash
near-dedup, mixing, byte-level BPE.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs, so a lost executor costs
at most the stage it was working on. All stages but the last return the
columns of ``documents``; each works on all that its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from batchgate.llm import bpe, exact_dedup, mixing, quality, simhash
from batchgate.llm.common import shipped, small_side, written

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score below its cut) go; documents without text too, if it says so."""
    labels = shipped(spark).read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels, allowed=F.crc32(F.col("id").cast("string")) % 5 != 0)
    score = quality.scorer(model)(F.col("text").cast("binary"))
    return docs.where(score >= quality.CUT)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal normalised texts stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def row_key(prefix: str = "") -> Column:
    """What tells rows apart, ids first (rows without one last): id and text."""
    text = F.coalesce(F.col(f"{prefix}text"), F.lit(""))
    doc_id = F.col(f"{prefix}doc_id")
    return F.struct(doc_id.isNull().alias("z"), F.coalesce(doc_id, F.lit(0)).alias("id"), F.sha2(text, 256).alias("sha"))


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each SimHash component stays, also where ids
    repeat or lack (then the smallest digest of the text). Rows that repeat id and
    text share a decision; the stage before leaves one of them."""
    whole = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(row_key().alias("row_key"), "text")
    found = simhash.near_dedup(rows, id_col="row_key", shingle=4, max_bits=4)
    lost = written(found.where("id <> component_id").select(F.col("id").alias("lost_key")).distinct(), "pipeline_lost")
    left = docs.select(F.struct(*whole).alias("d")).withColumn("row_key", row_key("d."))
    return left.join(small_side(lost), F.expr("row_key = lost_key"), "left_anti").select("d.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it. Where ids repeat or lack, rows
    are told apart by id and text."""
    # Rows travel as one struct each, so no column of docs can clash with the mix's.
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"))
    if docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty():
        taken, key = mixing.mix(docs), F.col("d.doc_id")
    else:
        digest = F.concat_ws(":", F.col("doc_id").cast("string"), F.sha2(F.coalesce("text", F.lit("")), 256))
        taken = mixing.mix(docs.select(digest.alias("row_key"), "text", "source"), id_col="row_key")
        key = F.concat_ws(":", F.col("d.doc_id").cast("string"), F.sha2(F.coalesce("d.text", F.lit("")), 256))
    taken = written(taken.select("id", "size", "copies"), "pipeline_copies")
    left, right = left.withColumn("k", key), taken.select(F.struct("*").alias("t"))
    same = F.expr("k = t.id")
    if not taken.groupBy("id").count().where("count > 1").isEmpty():
        # Rows that repeat id and text (none come from the stages before): told apart by their rank.
        left = left.withColumn("i", F.row_number().over(W.partitionBy("k").orderBy("k")))
        right = right.withColumn("j", F.row_number().over(W.partitionBy("t.id").orderBy("t.copies")))
        same = same & (F.col("i") == F.col("j"))
    # The copies are as many as the documents: always a shuffle.
    rows = left.join(right.where("t.copies > 0").hint("merge"), same)
    return rows.select("d", F.explode(F.array_repeat(F.lit(0), F.col("t.copies").cast("int"))).alias("copy")).select("d.*")


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and whether the ids decode to the text."""
    path = public_tokenizers.path(VOCABULARY)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct("doc_id", "lang", "source", F.sha2(text, 256).alias("sha")).alias("key"), text.alias("text"))
    out = bpe.encode_decode(rows, path, public_tokenizers.PATTERN, id_col="key")
    return out.select("id.doc_id", "id.lang", "id.source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                      (F.sha2("decoded", 256) == F.col("id.sha")).alias("round_trip"))


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_exact),
    ("simhash_near_dedup", drop_near),
    ("mixing", mix_sources),
    ("bpe", encode_tokens),
]

#: Byte-pair merges, entropy balancing and the learned classifier are no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE_SQLS = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
