"""Periodic runs of words inside a text by seed-and-extend along diagonals.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and at least max(24, 3q) words, which no neighbouring word extends
keeping period q. On the diagonal of lag q (word i beside word i + q) it is a
match of at least max(24 - q, 2q) words: 16 at the least, and 2q for the longer
lags. These guaranteed overlaps are the lengths of the indexed k-grams: 16-grams
serve the lags below 16, 32-grams the lags 16 to 31, 64-grams 32 to 63, and so on.
A k-gram's number comes from the numbers of its two halves, so equal numbers are
equal words, not equal hashes.

Seeds are pairs of one document's occurrences of a k-gram that follow each
other directly, at a lag that this k serves. No run is lost: if the k-gram at its
first word came again before lag q, at p < q <= k, the words from there to the end of the
second occurrence would have both periods and be at least p + q long, so the
run would have a period that divides both (Fine and Wilf), smaller than q. Therefore the pairs
are fewer than the words at each k, however often one k-gram occurs. A table of
the furthest match end by lag drops seeds inside a match that was extended before.

Defined results
  * NULL, empty and short texts have no runs and keep all their words.
  * Every row is treated alone: repeated rows and repeated or NULL ids give the
    same result as often as they occur.
  * Words are bytes between the six white-space characters, compared exactly.
  * Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchgate.llm.common import shipped

MIN_WORDS = 24
MIN_REPEATS = 3
RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])
SLICE_BYTES = 4 << 20


def seed_length(min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> int:
    """The shortest match on a diagonal that any run guarantees."""
    return min(max(min_words - q, (min_repeats - 1) * q) for q in range(1, min_words + 1))


def _matched(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements agree; compared in growing pieces."""
    done, size, n = 0, 64, min(len(a), len(b))
    while done < n:
        to = min(n, done + size)
        differ = np.flatnonzero(a[done:to] != b[done:to])
        if len(differ):
            return done + int(differ[0])
        done, size = to, 2 * size
    return n


def _seeds(grams: np.ndarray, low: int, high: int) -> Iterator[tuple[int, int]]:
    """(position, lag) of occurrences that follow each other directly, low <= lag < high, left to right."""
    order = np.argsort(grams, kind="stable")
    lag = np.diff(order)
    hit = np.flatnonzero((np.diff(grams[order]) == 0) & (lag >= low) & (lag < high))
    hit = hit[np.argsort(order[hit], kind="stable")]
    return zip(order[hit].tolist(), lag[hit].tolist())


def runs_of(codes: np.ndarray, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of word numbers, by start, then period."""
    n, k, first = len(codes), 1, seed_length(min_words, min_repeats)
    found: list[tuple[int, int, int]] = []
    grams, low = codes, 1
    while True:
        if k < first:                          # grow to the first seed length by doubling, the last step by overlap
            step = min(k, first - k)
        elif k > n - low:                      # no two k-grams at a lag of this level
            break
        else:
            covered: dict[int, int] = {}
            for at, lag in _seeds(grams, low, k):
                if at < covered.get(lag, 0):
                    continue
                end = at + k + _matched(codes[at + k:], codes[at + k + lag:])
                start = at - _matched(codes[:at][::-1], codes[lag:at + lag][::-1])
                covered[lag] = end
                if end - start + lag >= max(min_words, min_repeats * lag):
                    found.append((start, end - start + lag, lag))
            low, step = k, k
        if n < k + step:
            break
        pairs = grams[:n - k - step + 1].astype(np.int64) * (n + 1) + grams[step:]
        values, grams = np.unique(pairs, return_inverse=True)
        k += step
        if len(values) == len(grams):          # nothing repeats: no longer k-gram does either
            break
    return sorted(found, key=lambda r: (r[0], r[2]))


def _greatest(runs: list[tuple[int, int, int]]) -> int | None:
    """Index of the run with the greatest exact length / period (ties: smallest start, then period)."""
    best = None
    for i, (_, length, period) in enumerate(runs):
        if best is None or length * runs[best][2] > runs[best][1] * period:
            best = i
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by single spaces."""
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
              min_repeats: int = MIN_REPEATS) -> DataFrame:
    """id, runs (all, by start, then period), best (the index of the run with the
    greatest length / period, NULL without runs), collapsed (binary) of every row.

    ``min_repeats`` must be 3 or more: the seeds of the longer lags rest on matches of two periods.
    """
    if min_repeats < 3 or min_words < 2:
        raise ValueError("min_repeats must be at least 3 and min_words at least 2")
    shipped(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("runs", T.ArrayType(RUN, False)),
                           T.StructField("best", T.IntegerType()), T.StructField("collapsed", T.BinaryType())])
    run_type = pa.list_(pa.struct([pa.field(n, pa.int64()) for n in RUN.names]))

    def one(text: bytes | None) -> tuple[list[dict], int | None, bytes]:
        words = (text or b"").split()          # bytes: the six white-space bytes only
        numbers: dict[bytes, int] = {}
        codes = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
        runs = runs_of(codes, min_words, min_repeats) if len(words) - len(numbers) >= min_words * 2 // 3 else []
        return [dict(zip(RUN.names, r)) for r in runs], _greatest(runs), collapsed(words, runs) if runs else b" ".join(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, size, done = 0, 0, []
            for i in range(batch.num_rows):
                done.append(one(batch.column(1)[i].as_py()))
                size += len(done[-1][2])
                if size >= SLICE_BYTES or i + 1 == batch.num_rows:       # long texts leave in batches of their own
                    runs, best, kept = zip(*done)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(done)), pa.array(runs, run_type),
                                                      pa.array(best, pa.int32()), pa.array(kept, pa.binary())], names=schema.names)
                    start, size, done = i + 1, 0, []

    return rows.mapInArrow(run, schema)
