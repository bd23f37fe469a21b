"""Exact dedup by progressive refinement, DataFrame functions only.

Rows are counted by the length of their normalised text; first characters
are hashed for rows of a repeated length only; and rows that still share both
are read in full and hashed with SHA-256. Each refinement is a counting
aggregate (combined before the shuffle) and a join against the counts, so
adaptive execution can split a group that holds a third of all rows. Past
the length step at most ``prefix_chars`` characters of a text travel.

Defined results
  * NULL text counts as empty; all empty texts form one group.
  * Of equal texts the row with most code points in the original text stays,
    then the smallest id (a NULL id only if there is no other).
  * Rows of one id with equal texts share a decision; of those that stay together,
    :func:`drop_exact_duplicates` keeps the one with most code points (ties: the
    greatest text), NULL ids included.
  * Empty tables give empty results; other columns of the input are ignored
    by the decisions, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import small_side, squeezed, written

PREFIX_CHARS = 256


def normalised(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.length(text).cast("long").alias("n_chars"),
                       squeezed(text).alias("norm"))


def with_digest(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n_chars and the SHA-256 of the normalised text of every row."""
    return normalised(docs, id_col, text_col).select("id", "n_chars", F.sha2("norm", 256).alias("sha"))


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """The members of every group of two or more rows with equal texts.

    Returns one row per (id, sha): id, sha, keep_id, group_size, n_id (how many
    rows of the group have this id). Rows not listed are unique.
    """
    rows = normalised(docs, id_col, text_col)
    lengths = rows.select(F.octet_length("norm").alias("n_bytes")).groupBy("n_bytes").agg(F.count(F.lit(1)).alias("n"))
    lengths = written(lengths.where("n > 1").select("n_bytes"), "dedup_lengths")
    heads = rows.select("id", F.octet_length("norm").alias("n_bytes"), F.substring("norm", 1, prefix_chars).alias("head"))
    keys = heads.join(small_side(lengths), "n_bytes", "left_semi").select("id", "n_bytes", F.xxhash64("head").alias("prefix"))
    keys = written(keys, "dedup_keys")
    suspects = keys.groupBy("n_bytes", "prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("n_bytes", "prefix")
    suspects = written(suspects, "dedup_suspects")
    survivors = written(keys.join(suspects, ["n_bytes", "prefix"]).select("id"), "dedup_survivors")

    full = (rows.alias("r").join(survivors.alias("s"), F.expr("r.id <=> s.id"), "left_semi")
                .select("id", "n_chars", F.sha2("norm", 256).alias("sha")))
    full = full.groupBy("sha", "id").agg(F.max("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("n_id"))
    full = written(full, "dedup_full")
    best = F.min(F.struct((-F.col("n_chars")).alias("o"), F.col("id").isNull().alias("z"), F.col("id")))
    groups = (full.groupBy("sha").agg(F.sum("n_id").alias("group_size"), best.alias("best"))
                  .where("group_size > 1").select("sha", "group_size", F.col("best.id").alias("keep_id")))
    groups = written(groups, "dedup_groups")
    return full.select("id", "sha", "n_id").join(groups, "sha")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per input row, dropped ones too: id, sha, keep_id, group_size, kept."""
    members = written(duplicate_groups(docs, id_col, text_col, prefix_chars), "dedup_members")
    rows = with_digest(docs, id_col, text_col)
    out = rows.alias("r").join(members.alias("m"), F.expr("r.id <=> m.id AND r.sha = m.sha"), "left")
    keep = F.when(F.col("m.sha").isNull(), F.col("r.id")).otherwise(F.col("m.keep_id"))
    return out.select(F.col("r.id").alias("id"), F.col("r.sha").alias("sha"), keep.alias("keep_id"),
                      F.coalesce("m.group_size", F.lit(1)).cast("long").alias("group_size"),
                      keep.eqNullSafe(F.col("r.id")).alias("kept"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    members = written(duplicate_groups(docs, id_col, text_col), "dedup_members")
    sha = F.sha2(squeezed(F.coalesce(F.col(f"d.`{text_col}`"), F.lit(""))), 256)
    same = F.col(f"d.`{id_col}`").eqNullSafe(F.col("m.id")) & (sha == F.col("m.sha"))
    losers = written(members.where("NOT (id <=> keep_id)").select("id", "sha"), "dedup_losers")
    kept = docs.alias("d").join(small_side(losers).alias("m"), same, "left_anti")
    repeated = members.where("id <=> keep_id AND n_id > 1").select("id", "sha")
    if repeated.isEmpty():                 # no id holds two rows of a group: nothing more to drop
        return kept
    # Folded before the shuffle, so a group without ids may hold any number of rows.
    whole = F.struct(*[F.col(f"d.`{c}`") for c in docs.columns])
    text = F.coalesce(F.col(f"d.`{text_col}`"), F.lit(""))
    once = (kept.alias("d").join(repeated.alias("m"), same).groupBy("m.id", "m.sha")
                .agg(F.max_by(whole, F.struct(F.length(text), text)).alias("row")).select("row.*"))
    return kept.alias("d").join(repeated.alias("m"), same, "left_anti").unionByName(once)
