"""Small frames with the awkward cases that every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

#: Names that operators use inside; as extra columns of the input they must do no harm.
CLASHING = ["id", "norm", "sha", "size", "cls", "src", "fp", "chunk", "keys", "ids", "kept", "score", "copies", "n", "node", "root",
            "component_id", "group_size", "keep_id", "decoded", "_copies", "key", "text_sha256", "row", "path", "turns", "label"]


def documents(spark, rows, clash=True):
    """(doc_id, text, lang, source) rows as a documents table with extra columns."""
    rows = [(*r, None, None)[:4] for r in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING}) if clash else df


def words(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary):x}" for _ in range(n))


def awkward(seed: int = 0) -> list[tuple]:
    """NULLs, empty, blank and very long texts, ties, repeated rows, NULL ids."""
    rng = random.Random(seed)
    long = words(rng, 60_000)
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, long), (5, long + " tail"), (6, "one"), (7, "ONE"), (8, "one"),
            (8, "one"), (9, "o\nn e"), (None, "one"), (None, None), (10, "é ñ 漢字 \U0001f600"), (11, "x" * 5000), (12, "\x00 zero byte")]
    rows += [(20 + i, words(rng, 5 + rng.randrange(200))) for i in range(40)]
    rows += [(100 + i, rows[20 + i][1]) for i in range(5)] + [(110 + i, rows[25 + i][1] + " end") for i in range(5)]
    return [(i, t, "en", rng.choice(["a", "b", None])) for i, t in rows]
