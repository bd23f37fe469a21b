"""Helpers shared by the training-data operators: tables written to the
cluster's shared folder, and the fixed white-space set of their contracts."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchgate.session import scratch_path

#: Fixed value: the characters of ``[\x20\x09-\x0D]``.
SPACES = " \t\n\x0b\x0c\r"
#: Fixed value: one word.
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: cuts the lineage (a
    lost executor costs no recomputation) and gives later joins measured
    sizes. The table is read back under the frame's own schema."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def squeezed(text: Column) -> Column:
    """``text`` without its white space."""
    return F.translate(text, SPACES, "")


def word_count(text: Column) -> Column:
    """Number of words, counted without building an array of them: every word
    becomes one character, then the white space goes."""
    return F.length(squeezed(F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "x"))).cast("long")


#: Rows of a written table of ids (some 100 bytes each at most) that may be broadcast: 20 MB.
BROADCAST_ROWS = 200_000


def small_side(table: DataFrame) -> DataFrame:
    """A written table of ids as the small side of a join with whole documents:
    broadcast if its counted rows are within the bound, else joined by a
    shuffle (said outright, so that the plan does not depend on estimates)."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table.hint("merge")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def shipped(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors' Python once per application, so the
    operators that run Python there need no installation on the workers."""
    sc = spark.sparkContext
    if not getattr(sc, "_batchgate_shipped", False):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="batchgate-py-"), "batchgate.zip")   # served from the driver
        with zipfile.ZipFile(target, "w") as z:
            for folder, _, names in os.walk(package):
                for name in sorted(n for n in names if n.endswith(".py")):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
        sc.addPyFile(target)
        sc._batchgate_shipped = True
    return spark
