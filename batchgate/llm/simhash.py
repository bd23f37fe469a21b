"""SimHash near-dedup through a byte-position inverted index with count filtering.

A fingerprint of 64 bits is 8 positional bytes. Two fingerprints that differ
in at most d bits share at least 8 - d positional bytes, so for d = 4 a pair
must share 4 of the 8. Posting lists of a single (position, byte) would be
N / 256 long; the index therefore posts each fingerprint under combinations
of three positions, by a Turan system: 20 triples of which at least one lies
inside any 4 of the 8 positions. A pair with 4 shared bytes thus always meets
in a posting, with lists of about N / 2^24. Inside a posting the shared
positional bytes of each pair are tallied, pairs below the guaranteed minimum
are dropped, and the rest are verified by their bit distance.

Only connections are needed, not all pairs: a posting returns the edges of a
spanning forest of its links (at most one less than its fingerprints).
Equal fingerprints are one node. Postings with more than ``HOT`` distinct
fingerprints are cut into chunks, and every pair of chunks is a group of its
own, so no task gets an unbounded posting.

Defined results
  * NULL or wordless text has fingerprint 0 and links like any other.
  * Repeated rows get the same fingerprint and component. Rows with a NULL id
    take part; component_id is the smallest non-NULL id (NULL if there is none).
  * Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchgate.llm.common import partitions, shipped, written
from batchgate.llm.components import connected

SHINGLE = 4
MAX_BITS = 4
HOT = 4096
CHUNK = 2048
_LANES = np.uint64(0x0101010101010101)


# -------------------------------------------------------------- fingerprints

def fingerprint_of(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash over word shingles (XXH64, seed 42, repeats included)."""
    import xxhash

    words = (text or b"").lower().split()          # bytes: A-Z and the six white-space bytes only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, 42)]
    else:
        hashes = [digest(joined[s:e - 1], 42) for s, e in zip(starts, ends[shingle - 1:])]
    h = np.array(hashes, dtype=np.uint64)
    # Bits are counted eight at a time: bit k of each byte in a lane of its own, 255 rows a sum.
    counts = np.empty((8, 8), dtype=np.int64)
    blocks = np.arange(0, len(h), 255)
    for k in range(8):
        lanes = np.add.reduceat((h >> np.uint64(k)) & _LANES, blocks)
        counts[:, k] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    bits = (counts * 2 > len(h)).astype(np.uint8)
    return int(np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """id and fp (the 64 bits as a signed long) of every row."""
    shipped(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint_of(x.as_py(), shingle) for x in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    return rows.mapInArrow(run, schema)


# --------------------------------------------------------------------- index

def turan_triples() -> list[tuple[int, int, int]]:
    """20 triples of the 8 positions; every 4 positions hold one of them.

    The positions are put in three parts in a ring; a triple inside a part, or
    with two positions in a part and one in the next, is taken.
    """
    parts = [(0, 1, 2), (3, 4, 5), (6, 7)]
    out = [t for p in parts for t in combinations(p, 3)]
    for i, p in enumerate(parts):
        out += [(*two, one) for two in combinations(p, 2) for one in parts[(i + 1) % 3]]
    return out


def _masks(max_bits: int) -> list[int]:
    """Byte masks of the position combinations that a pair within max_bits must share one of."""
    if max_bits == 4:
        combos = turan_triples()
    elif 0 <= max_bits <= 7:               # any 8 - d shared positions are a combination themselves
        combos = list(combinations(range(8), 8 - max_bits))
    else:
        raise ValueError("max_bits must be between 0 and 7")
    out = []
    for combo in combos:
        mask = sum(0xFF << (8 * p) for p in combo)
        out.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return out


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Count filter, then verification: shared positional bytes, then differing bits."""
    x = np.ascontiguousarray(a ^ b)
    shared = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    ok = shared >= 8 - max_bits
    ok[ok] = np.bitwise_count(x[ok]) <= max_bits
    return ok


def _forest(fp: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges of a spanning forest of the links within one posting: every
    fingerprint is compared with those not reached yet."""
    edges, rest, front = [], fp, []
    while len(rest):
        if not front:
            front, rest = [rest[0]], rest[1:]
        at = front.pop()
        near = _near(np.full(len(rest), at, dtype=np.uint64), rest, max_bits)
        if near.any():
            found, rest = rest[near], rest[~near]
            edges.append((np.full(len(found), at, dtype=np.uint64), found))
            front.extend(found)
    return edges


def _links(max_bits: int):
    """Postings, sorted by key, to links. Short runs are compared at growing
    offsets, all runs of a batch at once; long ones by their forest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3 + [np.empty(0, np.uint64)]

        def links(cols: list[np.ndarray]) -> pa.RecordBatch | None:
            *key, fp = cols
            if len(fp) < 2:
                return None
            new = np.ones(len(fp), bool)
            new[1:] = np.any([k[1:] != k[:-1] for k in key], axis=0)
            start = np.flatnonzero(new)
            size = np.diff(np.append(start, len(fp)))
            left = np.repeat(start + size, size) - np.arange(len(fp)) - 1      # rows of the run that follow
            a, b = [], []
            small = np.repeat(size <= 64, size)
            at, offset = np.flatnonzero(small & (left > 0)), 1
            while len(at):
                ok = _near(fp[at], fp[at + offset], max_bits)
                a.append(fp[at[ok]])
                b.append(fp[at[ok] + offset])
                offset += 1
                at = at[left[at] >= offset]
            for i in np.flatnonzero(size > 64):
                for x, y in _forest(fp[start[i]:start[i] + size[i]], max_bits):
                    a.append(x)
                    b.append(y)
            if not sum(map(len, a)):
                return None
            pair = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0).astype(np.uint64)
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pair[:, i]).view(np.int64)) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            cols = [np.concatenate([h, c.astype(np.int64).view(h.dtype)]) for h, c in zip(held, cols)]
            if not len(cols[3]):
                continue
            last = np.ones(len(cols[3]), bool)                                   # the unfinished run at the end
            for k in cols[:3]:
                last &= k == k[-1]
            cut = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
            held = [c[cut:] for c in cols]
            if cut and (out := links([c[:cut] for c in cols])) is not None:
                yield out
        if (out := links(held)) is not None:
            yield out

    return run


def near_links(classes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """a, b: links between distinct fingerprints (column fp) that connect every
    pair within ``max_bits`` bits."""
    masks = _masks(max_bits)
    spark = shipped(classes.sparkSession)
    keys = F.array(*[F.struct(F.lit(j).cast("long").alias("j"), F.col("fp").bitwiseAND(F.lit(m)).alias("k"))
                     for j, m in enumerate(masks)])
    postings = classes.select("fp", F.explode(keys).alias("x")).select("x.j", "x.k", "fp")
    hot = written(postings.groupBy("j", "k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT), "simhash_hot")
    tiled = postings.withColumn("tile", F.lit(0).cast("long"))
    if not hot.isEmpty():
        # Chunks of a hot posting; each pair of chunks is one group.
        chunks = F.ceil(F.col("n") / CHUNK)
        mine = F.pmod(F.xxhash64("fp"), chunks)
        parts = postings.join(hot, ["j", "k"]).select("j", "k", "fp", chunks.alias("c"), mine.alias("i"))
        tiles = parts.select("j", "k", "fp", "c", "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("c") - 1)).alias("o"))
        tile = F.least("i", "o") * F.col("c") + F.greatest("i", "o") + 1
        tiled = (tiled.join(hot, ["j", "k"], "left_anti")
                      .unionByName(tiles.select("j", "k", "fp", tile.alias("tile"))))
    dealt = (tiled.select("j", "k", "tile", "fp").repartition(partitions(spark), "j", "k", "tile")
                  .sortWithinPartitions("j", "k", "tile", "fp"))
    return dealt.mapInArrow(_links(max_bits), "a long, b long").distinct()


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: id, fp, component_id (smallest id reachable by links)."""
    prints = written(fingerprints(docs, id_col, text_col, shingle), "simhash_prints")
    classes = written(prints.groupBy("fp").agg(F.min("id").alias("least_id")), "simhash_classes")
    roots = written(connected(near_links(classes.select("fp"), max_bits)), "simhash_roots")
    placed = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    placed = written(placed, "simhash_placed")
    least = written(placed.groupBy("root").agg(F.min("least_id").alias("component_id")), "simhash_least")
    components = written(placed.join(least, "root").select("fp", "component_id"), "simhash_components")
    return prints.join(components, "fp").select("id", "fp", "component_id")
