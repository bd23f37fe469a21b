"""Bloom filters over key columns, from built-in functions only.

A filter is one row with an array of 2**(log2_bits - 6) words of 64 bits. It
narrows the other side of a join to keys that may match before anything is
shuffled; a key it lets through by chance costs a row, never a wrong result.
Its size is fixed by ``log2_bits`` (8 MB at the most), whatever the data holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_LOG2, DEFAULT_LOG2, MAX_LOG2 = 16, 23, 26
#: Types whose equal values always have equal hashes (floating point has two zeros).
HASHABLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.BinaryType, T.BooleanType, T.DateType,
            T.TimestampType, T.TimestampNTZType, T.DecimalType)


def log2_bits(rows: int | None) -> int:
    """About ten bits a key (3 % chance hits) within the size bound."""
    return DEFAULT_LOG2 if rows is None else max(MIN_LOG2, min(MAX_LOG2, (10 * max(rows, 1)).bit_length()))


def same_hash(left: T.StructType, right: T.StructType, keys: list[str]) -> bool:
    """Whether equal keys of both sides hash alike: the same plain types on both sides."""
    return all(left[k].dataType == right[k].dataType and isinstance(left[k].dataType, HASHABLE) for k in keys)


def _positions(keys: list[str], bits: int) -> list[Column]:
    """Four bit positions: two slices of each of two hashes."""
    mask = F.lit((1 << bits) - 1)
    hashes = [F.xxhash64(*[F.col(k) for k in keys]), F.xxhash64(F.lit(1), *[F.col(k) for k in keys])]
    return [F.shiftrightunsigned(h, shift).bitwiseAND(mask) for h in hashes for shift in (0, bits)]


def build(frame: DataFrame, keys: list[str], bits: int = DEFAULT_LOG2) -> DataFrame:
    """One row, one column ``bloom``: the filter of the frame's keys. Words are combined before the shuffle."""
    at = frame.select(F.explode(F.array(*_positions(keys, bits))).alias("at"))
    words = (at.groupBy(F.shiftright("at", 6).alias("id"))
               .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))).alias("word")))
    dense = frame.sparkSession.range(1 << (bits - 6)).join(words, "id", "left")
    pairs = F.array_sort(F.collect_list(F.struct("id", F.coalesce("word", F.lit(0)).alias("word"))))
    return dense.agg(F.transform(pairs, lambda p: p["word"]).alias("bloom"))


def might_contain(bloom: Column, keys: list[str], bits: int = DEFAULT_LOG2) -> Column:
    """False only for keys that the filter's frame does not hold."""
    hit = None
    for at in _positions(keys, bits):
        word = F.get(bloom, F.shiftright(at, 6).cast("int"))
        one = F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1
        hit = one if hit is None else hit & one
    return hit
