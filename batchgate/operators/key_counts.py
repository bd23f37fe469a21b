"""Counts of key values of one batch, taken once and shared by all that needs them.

The unique-key rule, the failure audit, the valid / invalid split, the merge's
duplicate check and its hot-key routing all ask which keys repeat. One grouped
pass a key list writes the repeated keys with their counts (usually none) to the
shared scratch folder and observes the totals on that same write.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.predicates import any_null
from ..session import scratch_path

COUNT = "_bg_n"


@dataclass(frozen=True)
class KeyCount:
    rows: int               # rows of the batch
    null_rows: int          # rows with a NULL in the key
    repeated_rows: int      # rows of the keys that occur more than once
    excess: int             # the same without the first row of each key
    top: int                # rows of the most frequent key (0: no key at all)
    repeated: DataFrame     # the keys that occur more than once, with their count


class KeyCounts:
    """Key counts of ``df`` (a landed batch: it is read once for each key list)."""

    def __init__(self, df: DataFrame) -> None:
        self.df = df
        self.passes = 0
        self._known: dict[tuple[str, ...], KeyCount] = {}

    def of(self, keys: list[str]) -> KeyCount:
        key = tuple(keys)
        if key not in self._known:
            self._known[key] = self._count(list(keys))
        return self._known[key]

    def _count(self, keys: list[str]) -> KeyCount:
        self.passes += 1
        spark, n, null = self.df.sparkSession, F.col(COUNT), any_null(keys)
        grouped = self.df.groupBy(*keys).agg(F.count(F.lit(1)).alias(COUNT))      # partial counts before the shuffle
        again = ~null & (n > 1)
        obs = Observation("batchgate_keys")
        observed = grouped.observe(
            obs, F.sum(n).alias("rows"), F.sum(F.when(null, n)).alias("null_rows"), F.sum(F.when(again, n)).alias("repeated_rows"),
            F.sum(F.when(again, n - 1)).alias("excess"), F.max(F.when(~null, n)).alias("top"))
        path = scratch_path(spark, "key_counts")
        observed.where(again).write.parquet(path)
        got = {k: int(v or 0) for k, v in obs.get.items()}
        return KeyCount(repeated=spark.read.schema(grouped.schema).parquet(path), **got)
