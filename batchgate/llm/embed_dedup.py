"""Embedding near-dedup: vectors meet in the cells they are near to.

Some of the vectors, a few per ``shard_rows``, are centres of cells (a group of
near copies gives one centre only). A vector lies in its home, the cell of its
nearest centre, and visits every cell whose border with its home is within the
reach. A cell's vectors are compared with each other and with its visitors, so a
link is found if one of its two vectors visits the other's home. Within a cell
the same is done again with finer cells, between which the queries choose.
Nothing is sent to cells far away, so the work of a vector grows with the
vectors around it and not with the table.

Both reaches are set by an audit against brute force: over the whole table for
the cells, over the cell for the finer ones. Audited are some of the vectors,
and as many probes: vectors turned away from one of these to a cosine just above
the threshold. Each of the two audits demands the root of the demanded recall, by
query and by link, of vectors and of probes. A reach that misses it is widened,
at last to every cell, which is brute force.

Visitors travel as steps of 1/127 of their largest number, with the distance
from the truth. A cosine which that distance can't carry over the threshold is
decided; every other pair is decided by its cosine in doubles, of the vectors as
given. Nothing below the threshold is linked.

Equal vectors are told by 128 bits of their bytes and count as one with a
number, so a vector that a third of all rows repeat is compared once a cell. A
task returns, per vector, the number of linked vectors, and edges that join what
is linked in it (not all pairs). A cell with more vectors or visitors than a task
holds becomes several units: each part of the one with each part of the other.

Defined results
  * Vectors that are NULL, empty, zero, or hold NULL or non-finite components,
    and rows with a NULL id, link with nothing (n_links 0, own component).
  * Vectors of different lengths never link. Repeated rows count as vectors.
  * Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import shipped, small_side, written
from batchgate.llm.components import connected

THRESHOLD = 0.9
SHARD_ROWS = 32_768           # vectors of a cell, so that a task's share of the memory holds it with its queries
MIN_SHARDS = 6
CHUNK_VALUES = 1 << 21        # numbers dealt at once: 32,768 vectors of 64
INDEX_VALUES = 1 << 23        # numbers in a unit's vectors, and in its queries: beyond, a cell becomes several units
VISIT_VALUES = 1 << 26
QUERY_VALUES = 1 << 21        # numbers of queries taken at once within a unit
PAIRS = 1 << 20               # similarities computed at once
FINE = 2                      # finer cells in a unit: so many times the root of its vectors
FINE_FROM = 4096              # smaller units are compared in full
CELL_AUDITS = 512             # vectors, and as many probes, that set the reach of cells
RECALL = 0.98
AUDITS = 64
M = 16                       # neighbours on the upper layers; twice as many on the lowest
BUILD_BEAM = 64              # a better graph passes the audit at a narrow beam; a wide beam costs every query
BEAM = 32


class SmallWorld:
    """Hierarchical navigable small-world graph over unit vectors (float32), for
    searches one by one; ``near_dedup`` compares whole cells instead."""

    def __init__(self, x: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]], beam: int = BEAM):
        self.x, self.layers, self.beam = x, layers, beam     # layer: node ids, neighbours (-1: none); lowest first

    # ---- search

    def _walk(self, q: np.ndarray, entry: np.ndarray, links: np.ndarray, beam: int, expand: int = 4):
        """Best ``beam`` nodes for each query (ids, similarities), all queries in
        lockstep: each round expands the best unexpanded places of every beam."""
        n, width = len(q), links.shape[1]
        seen = np.zeros((n, len(self.x) + 1), bool)
        seen[:, -1] = True                                    # the place of "no neighbour"
        rows = np.arange(n)[:, None]
        ids = np.full((n, beam), -1)
        sims = np.full((n, beam), -np.inf, np.float32)
        k = min(entry.shape[1], beam)
        ids[:, :k] = entry[:, :k]
        sims[:, :k] = np.where(ids[:, :k] >= 0, np.einsum("qkd,qd->qk", self.x[ids[:, :k]], q), -np.inf)
        seen[rows, ids[:, :k]] = True
        fresh = ids >= 0
        live = np.arange(n)
        while len(live):
            s = np.where(fresh[live], sims[live], -np.inf)
            e = min(expand, beam)
            pick = np.argpartition(-s, e - 1, axis=1)[:, :e] if e < beam else np.tile(np.arange(beam), (len(live), 1))
            ok = np.take_along_axis(s, pick, 1) > -np.inf
            go = ok.any(axis=1)
            live, pick, ok = live[go], pick[go], ok[go]
            if not len(live):
                break
            at = np.where(ok, ids[live[:, None], pick], -1)
            fresh[live[:, None], pick] = False
            near = np.where(at[..., None] >= 0, links[at], -1).reshape(len(live), -1)
            near = np.sort(near, axis=1)                      # repeats within a round count once
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            old = seen[live[:, None], near]
            near[old] = -1
            seen[live[:, None], near] = True
            new = np.where(near >= 0, np.einsum("qkd,qd->qk", self.x[near], q[live]), -np.inf).astype(np.float32)
            all_s = np.concatenate([sims[live], new], axis=1)
            all_i = np.concatenate([ids[live], near], axis=1)
            all_f = np.concatenate([fresh[live], near >= 0], axis=1)
            top = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
            sims[live], ids[live], fresh[live] = (np.take_along_axis(v, top, 1) for v in (all_s, all_i, all_f))
            ids[sims == -np.inf] = -1
            fresh &= ids >= 0
        order = np.argsort(-sims, axis=1)
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def descend(self, q: np.ndarray, to: int) -> np.ndarray:
        """Entry points for layer ``to``: a small beam down the layers above it."""
        entry = np.tile(self.layers[-1][0][:1], (len(q), 1))
        for level in range(len(self.layers) - 1, to, -1):
            entry = self._walk(q, entry, self.layers[level][1], 4)[0]
        return entry

    def search(self, q: np.ndarray, beam: int, block: int = 256):
        for i in range(0, len(q), block):
            part = q[i:i + block]
            yield i, *self._walk(part, self.descend(part, 0), self.layers[0][1], min(beam, len(self.x)))

    def whole(self, beam: int) -> bool:
        """Whether a search with ``beam`` would touch as many nodes as there are."""
        return beam * self.layers[0][1].shape[1] >= len(self.x)

    def within(self, q: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, node) pairs of similarity ``least`` or more; a beam whose last
        place is still above it is widened and searched again."""
        todo, beam = np.arange(len(q)), self.beam
        while len(todo):
            if self.whole(beam):
                block = max(1, min(256, (1 << 22) // len(self.x)))
                for i in range(0, len(todo), block):
                    at, node = np.nonzero(q[todo[i:i + block]] @ self.x.T >= least)
                    yield todo[i + at], node
                return
            again = []
            # Wide beams take small blocks, so that memory stays the same.
            for i, ids, sims in self.search(q[todo], beam, max(16, min(256, 32 * 256 // beam))):
                own = todo[i:i + len(ids)]
                wide = sims[:, -1] >= least
                again.append(own[wide])
                hit = (sims >= least) & ~wide[:, None]
                at, place = np.nonzero(hit)
                yield own[at], ids[at, place]
            todo, beam = np.concatenate(again), beam * 4

    def audit(self, least: float, recall: float = RECALL, audits: int = AUDITS) -> None:
        """Doubles the base beam until audited queries find ``recall`` of their links.

        Audited are some of the shard's own vectors, against brute force, and as
        many probes: vectors turned away from one of these to a cosine just
        above the threshold, which must find it. Vectors and probes are judged
        apart, by the mean over the queries that have links (a large group
        counts no more than a pair) and by all links; a vector's link to itself
        does not count. Nine in ten of the vectors' ten nearest must be found
        too, whether above the threshold or not.
        """
        pick = np.linspace(0, len(self.x) - 1, min(audits, len(self.x))).astype(int)
        own = self.x[pick]
        away = np.random.default_rng(11).normal(size=own.shape)
        away -= np.einsum("qd,qd->q", away, own)[:, None] * own
        away /= np.maximum(1e-12, np.linalg.norm(away, axis=1))[:, None]
        cosine = min(1.0, least + 0.002)
        probes = (cosine * own + np.sqrt(1 - cosine ** 2) * away).astype(np.float32)
        k = min(10, len(self.x))
        true = np.argsort(-(own @ self.x.T), axis=1)[:, :k]
        sets = []
        for queries in (own, probes):
            links = queries @ self.x.T >= least
            if queries is own:
                links[np.arange(len(pick)), pick] = False
            sets.append((queries, links))

        def passed() -> bool:
            for queries, links in sets:
                found = np.zeros_like(links)
                for at, node in self.within(queries, least):
                    found[at, node] = True
                have, want = (found & links).sum(axis=1), links.sum(axis=1)
                some = want > 0
                if some.any() and min(np.mean(have[some] / want[some]), have.sum() / want.sum()) < recall:
                    return False
            ids = np.concatenate([ids for _, ids, _ in self.search(own, self.beam)])
            return np.mean([len(np.intersect1d(a, b)) / k for a, b in zip(true, ids)]) >= 0.9

        while not self.whole(self.beam) and not passed():
            self.beam *= 2

    # ---- construction

    def _choose(self, q: np.ndarray, ids: np.ndarray, sims: np.ndarray, m: int) -> np.ndarray:
        """At most ``m`` neighbours of each query, nearest first, leaving out one
        that is nearer to a chosen neighbour than to the query; places that stay
        free go to the nearest left out."""
        n, width = ids.shape
        v = self.x[ids]
        between = np.einsum("qad,qbd->qab", v, v)
        chosen = np.zeros((n, width), bool)
        for j in range(width):
            worst = np.where(chosen, between[:, j], -np.inf).max(axis=1, initial=-np.inf)
            chosen[:, j] = (ids[:, j] >= 0) & (sims[:, j] > worst) & (chosen.sum(axis=1) < m)
        rank = np.where(chosen, 0, np.where(ids >= 0, 1, 2)) * width + np.arange(width)
        order = np.argsort(rank, axis=1)[:, :m]
        return np.take_along_axis(np.where(rank < 2 * width, ids, -1), order, 1)

    def _link(self, level: int, nodes: np.ndarray, near: np.ndarray) -> None:
        """Adds edges both ways; a full neighbour list is chosen anew."""
        links = self.layers[level][1]
        m = links.shape[1]
        links[nodes, :near.shape[1]] = near
        src, dst = np.repeat(nodes, near.shape[1]), near.ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        for part in np.array_split(np.unique(dst), max(1, len(dst) // 4096)):
            lo, hi = np.searchsorted(dst, part, "left"), np.searchsorted(dst, part, "right")
            most = int((hi - lo).max(initial=0))
            back = lo[:, None] + np.arange(most)
            extra = np.where(back < hi[:, None], src[np.minimum(back, len(src) - 1)], -1)
            cand = np.concatenate([links[part], extra], axis=1)
            cand = np.sort(cand, axis=1)
            cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
            sims = np.where(cand >= 0, np.einsum("qkd,qd->qk", self.x[cand], self.x[part]), -np.inf)
            order = np.argsort(-sims, axis=1)[:, :3 * m]
            cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
            full = (cand >= 0).sum(axis=1) > m
            links[part[~full]] = np.pad(cand[~full], ((0, 0), (0, max(0, m - cand.shape[1]))), constant_values=-1)[:, :m]
            if full.any():
                links[part[full]] = self._choose(self.x[part[full]], cand[full], sims[full], m)

    @classmethod
    def build(cls, x: np.ndarray, m: int = M, beam: int = BUILD_BEAM, seed: int = 7) -> "SmallWorld":
        n = len(x)
        level = np.minimum(np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(m)).astype(int), 6)
        level[0] = level.max(initial=0)
        layers = [(np.flatnonzero(level >= k), np.full((n, 2 * m if k == 0 else m), -1)) for k in range(level[0] + 1)]
        self = cls(x, layers)
        done = 1
        while done < n:
            batch = np.arange(done, min(n, done + min(max(done, 32), 512)))       # rounds grow with the graph
            for k in range(len(layers) - 1, -1, -1):
                own = batch[level[batch] >= k]
                if not len(own):
                    continue
                entry = self.descend(x[own], k)
                ids, sims = self._walk(x[own], entry, layers[k][1], beam)
                # Nodes of one round also see each other.
                peers = x[own] @ x[own].T
                np.fill_diagonal(peers, -np.inf)
                peer_ids = np.where(np.isfinite(peers), own[None, :], -1)
                keep = np.argsort(-np.concatenate([sims, peers], axis=1), axis=1)[:, :beam]
                ids = np.take_along_axis(np.concatenate([ids, peer_ids], axis=1), keep, 1)
                sims = np.take_along_axis(np.concatenate([sims, peers], axis=1), keep, 1)
                self._link(k, own, self._choose(x[own], ids, sims, m))
            done = batch[-1] + 1
        return self


# ---------------------------------------------------------------------- cells

class Cells:
    """Cells around some of the vectors: a unit vector's home is the cell of its
    nearest centre, and it visits the cells whose border with its home is no
    farther than ``reach``."""

    BLOCK = 1024
    BINS = 1024                                               # steps of a reach up to 1; beyond: every cell

    def __init__(self, centres: np.ndarray, reach: float = 0.0):
        self.centres, self.reach = centres.astype(np.float32), reach
        self.apart = np.sqrt(np.maximum(1e-12, 2 - 2 * self.centres @ self.centres.T))
        self.most = float(self.apart.max(initial=0))

    @classmethod
    def among(cls, x: np.ndarray, k: int, least: float) -> "Cells":
        """Centres are the first ``k`` vectors that do not link with an earlier one:
        a group of near copies has one, however many of the vectors it is."""
        kept, n = np.zeros((max(1, k), x.shape[1]), np.float32), 0
        for v in x:
            if n == k:
                break
            if not n or (kept[:n] @ v).max() < least:
                kept[n] = v
                n += 1
        return cls(kept[:max(1, n)])

    def sims(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Similarities to the centres. Blocks have one size (the last is filled up), so
        a vector gets the same figures in every task, whatever stands beside it."""
        for i in range(0, len(x), self.BLOCK):
            part = x[i:i + self.BLOCK]
            m = len(part)
            if m < self.BLOCK:
                part = np.concatenate([part, np.zeros((self.BLOCK - m, x.shape[1]), np.float32)])
            yield i, (part @ self.centres.T)[:m]

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Home of each vector; (vector, cell) of the visits, without those at home."""
        home, rows, cells = np.zeros(len(x), np.int32), [], []
        for i, s in self.sims(x):
            h = s.argmax(axis=1)
            home[i:i + len(s)] = h
            top = s[np.arange(len(s)), h]
            at, cell = np.divmod(np.flatnonzero(s >= (top - min(self.reach * self.most, 9))[:, None]), s.shape[1])
            ok = (top[at] - s[at, cell] <= self.reach * self.apart[h[at], cell]) & (cell != h[at])
            rows.append((i + at[ok]).astype(np.int32))
            cells.append(cell[ok].astype(np.int32))
        return home, np.concatenate([np.empty(0, np.int32), *rows]), np.concatenate([np.empty(0, np.int32), *cells])

    def step(self, s: np.ndarray, home: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """The least step of the reach at which vectors of similarities ``s`` (a row each) visit ``cell``."""
        at = np.arange(len(s))
        far = np.where(home == cell, -1.0, (s[at, home] - s[at, cell]) / self.apart[home, cell])
        return np.where(far < 0, 0, np.minimum(1 + np.floor(far * self.BINS), self.BINS)).astype(np.int64)

    def reached(self, sets: list[np.ndarray], recall: float) -> "Cells":
        """Sets the reach at which audited queries find ``recall`` of their links, from
        the number of links of each query by the step that finds them. Each set of
        queries is judged apart, by the mean over the queries that have links (a
        large group counts no more than a pair) and by all links."""
        step = 0
        for counts in sets:
            found = np.cumsum(counts[counts.sum(axis=1) > 0], axis=1)
            if len(found):
                part = np.minimum((found / found[:, -1:]).mean(axis=0), found.sum(axis=0) / found[:, -1].sum())
                step = max(step, int(np.argmax(part >= recall - 1e-12)))
        self.reach = np.inf if step == self.BINS else step / self.BINS
        return self


def _probes(own: np.ndarray, least: float) -> np.ndarray:
    """Vectors turned away from ``own`` to a cosine just above the threshold."""
    away = np.random.default_rng(11).normal(size=own.shape)
    away -= np.einsum("qd,qd->q", away, own)[:, None] * own
    away /= np.maximum(1e-12, np.linalg.norm(away, axis=1))[:, None]
    cosine = min(1.0, least + 0.002)
    return (cosine * own + np.sqrt(1 - cosine ** 2) * away).astype(np.float32)


# --------------------------------------------------------------- Spark tasks

def _unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)                 # no overflow or underflow in the squares
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _keys(v: np.ndarray) -> np.ndarray:
    """128 bits of each vector's bytes, as two numbers: equal vectors are told by them."""
    width, raw = v.shape[1] * v.itemsize, memoryview(np.ascontiguousarray(v)).cast("B")
    return np.frombuffer(b"".join([hashlib.blake2b(raw[i:i + width], digest_size=16).digest() for i in range(0, len(raw), width)]),
                         np.int64).reshape(-1, 2)


def _first(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the first of each key, in the order of the keys; for every row, which of them it is."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    new = np.ones(len(keys), bool)
    new[1:] = (keys[order[1:]] != keys[order[:-1]]).any(axis=1)
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def _fine(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors) of a batch (id, v) that can link, by length; -0.0 counts as 0.0."""
    col, there = batch.column(1), np.asarray(pc.is_valid(batch.column(0)))
    size = np.asarray(pc.fill_null(pc.list_value_length(col), 0))
    flat = col.flatten().to_numpy(zero_copy_only=False)       # NULL: NaN
    start = np.cumsum(size) - size
    for dim in np.unique(size[there & (size > 0)]).tolist():
        rows = np.flatnonzero(there & (size == dim))
        v = flat.reshape(-1, dim) if len(rows) == len(size) else flat[start[rows][:, None] + np.arange(dim)]
        ok = np.isfinite(v).all(axis=1) & (v != 0).any(axis=1)
        if ok.any():
            yield rows[ok], v[ok] + v.dtype.type(0)


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id and key of every row; no key: it links with nothing."""
    for batch in batches:
        key, none = np.zeros((batch.num_rows, 2), np.int64), np.ones(batch.num_rows, bool)
        for rows, v in _fine(batch):
            key[rows], none[rows] = _keys(v), False
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(key[:, 0], mask=none), pa.array(key[:, 1], mask=none)], ["id", "k", "l"])


def _binary(v: np.ndarray) -> pa.Array:
    ends = np.arange(len(v) + 1, dtype=np.int32) * np.int32(v.shape[1] * v.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(v), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(v))])


def _vectors(most: int | None = None):
    """Key, length and bytes of the vectors; with ``most``, of those whose key is no greater."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, v in _fine(batch):
                key = _keys(v)
                if most is not None:
                    low = key[:, 0] <= most
                    key, v = key[low], v[low]
                if len(v):
                    at = _first(key)[0]
                    yield pa.RecordBatch.from_arrays([pa.array(key[at, 0]), pa.array(key[at, 1]), pa.array(np.full(len(at), v.shape[1], np.int32)),
                                                      _binary(v[at])], ["k", "l", "dim", "x"])
    return run


def _audited(model: dict, least: float):
    """Links of the audited queries by the step of the reach at which one of the two visits the other's home."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {dim: np.zeros((len(m["q"]), Cells.BINS + 1), np.int64) for dim, m in model.items()}
        for batch in batches:
            for _, v in _fine(batch):
                if (m := model.get(v.shape[1])) is None:
                    continue
                cells, x = m["cells"], _unit(v).astype(np.float32)
                for i in range(0, len(x), Cells.BLOCK):
                    part = x[i:i + Cells.BLOCK]
                    q, at = np.divmod(np.flatnonzero(m["q"] @ part.T >= least), len(part))
                    if not len(q):
                        continue
                    used, place = np.unique(at, return_inverse=True)
                    own = (q < len(m["key"])) & (m["key"][np.minimum(q, len(m["key"]) - 1)] == _keys(v[i + used])[place]).all(axis=1)
                    q, at = q[~own], at[~own]
                    for j in range(0, len(q), 1 << 14):
                        a, b = q[j:j + (1 << 14)], at[j:j + (1 << 14)]
                        used, b = np.unique(b, return_inverse=True)
                        s = np.concatenate([s for _, s in cells.sims(part[used])])
                        home = s.argmax(axis=1)[b]
                        step = np.minimum(cells.step(m["s"][a], m["home"][a], home), cells.step(s[b], home, m["home"][a]))
                        np.add.at(total[v.shape[1]], (a, step), 1)
        for dim, t in total.items():
            q, step = np.nonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), dim, np.int32)), pa.array(q.astype(np.int32)), pa.array(step.astype(np.int32)),
                                              pa.array(t[q, step])], ["dim", "q", "step", "links"])
    return run


def _index_type(dim: int, kind: str) -> np.dtype:
    return np.dtype([("key", "<i8", (2,)), ("n", "<i4"), ("visits", "<i4"), ("x", kind, (dim,))])


def _query_type(dim: int) -> np.dtype:
    """A vector in steps of ``scale``; ``err`` is its distance from what the steps give."""
    return np.dtype([("key", "<i8", (2,)), ("n", "<i4"), ("home", "<i4"), ("scale", "<f4"), ("err", "<f4"), ("code", "i1", (dim,))])


def _packed(rows: np.ndarray) -> bytes:
    """Their number and their fields byte by byte (all first bytes of a field, then all second), compressed."""
    planes = [np.ascontiguousarray(rows[f]).view(np.uint8).reshape(-1, rows.dtype[f].base.itemsize).T.tobytes() for f in rows.dtype.names]
    return len(rows).to_bytes(8, "little") + pa.compress(b"".join(planes), "zstd", asbytes=True) if len(rows) else b""


def _unpacked(blob: pa.Buffer, kind: np.dtype) -> np.ndarray:
    rows, at = np.zeros(int.from_bytes(blob[:8], "little"), kind), 0
    if len(rows):
        raw = pa.decompress(blob[8:], rows.nbytes, "zstd")
        for f in kind.names:
            part = np.frombuffer(raw, np.uint8, len(rows) * kind[f].itemsize, at)
            rows[f] = np.ascontiguousarray(part.reshape(kind[f].base.itemsize, -1).T).view(kind[f].base).reshape(rows[f].shape)
            at += len(part)
    return rows


def _dealt(model: dict):
    """Vectors to the units of their home (as they are, with the lower cells they visit)
    and of the cells they visit (as queries): one row for a unit and chunk."""
    def flush(dim: int, parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        v = np.concatenate(parts)
        key = _keys(v)
        first, which = _first(key)
        v, key, n = v[first], key[first], np.bincount(which).astype(np.int32)
        u = _unit(v)
        x = u.astype(np.float32)
        m = model.get(dim) or {"cells": Cells(np.zeros((1, dim))), "base": np.zeros(1, np.int64), "across": np.ones(1, np.int64), "down": np.ones(1, np.int64)}
        home, row, cell = m["cells"].visits(x)
        base, across, down = m["base"], m["across"], m["down"]
        index = np.zeros(len(v), _index_type(dim, v.dtype.str))
        lower = cell < home[row]
        index["key"], index["n"], index["x"], index["visits"] = key, n, v, np.bincount(row[lower], minlength=len(v))
        query = np.zeros(len(v), _query_type(dim))
        scale = np.abs(x).max(axis=1) / np.float32(127)
        code = np.rint(x / scale[:, None]).astype(np.int8)
        query["key"], query["n"], query["home"], query["scale"], query["code"] = key, n, home, scale, code
        query["err"] = np.linalg.norm(u - code * scale[:, None], axis=1) * 1.00001 + 1e-6
        lists = cell[lower][np.argsort(row[lower], kind="stable")]
        # A vector's own shares of a cell: one of ``down`` parts of the index, one of ``across`` parts of the queries.
        down_of, across_of = (key[:, 1] & 0xFFFF), (key[:, 1] >> 16 & 0xFFFF)
        several = np.flatnonzero((across * down)[home] > 1)    # there the vectors at home are queries like the visitors
        row, cell = np.concatenate([row, several]), np.concatenate([cell, home[several]])
        times = across[home]
        a = np.repeat(np.arange(len(v)), times)
        a_unit = base[home[a]] + down_of[a] % down[home[a]] * across[home[a]] + np.arange(len(a)) - np.repeat(np.cumsum(times) - times, times)
        times = down[cell]
        b, b_cell = np.repeat(row, times), np.repeat(cell, times)
        nth = np.arange(len(b)) - np.repeat(np.cumsum(times) - times, times)
        b_unit = base[b_cell] + nth * across[b_cell] + across_of[b] % across[b_cell]
        a, b = a[np.argsort(a_unit, kind="stable")], b[np.argsort(b_unit, kind="stable")]
        a_unit, b_unit = np.sort(a_unit), np.sort(b_unit)
        units = np.union1d(a_unit, b_unit)
        times, ends = index["visits"][a].astype(np.int64), np.cumsum(index["visits"], dtype=np.int64)
        lists = lists[np.repeat(ends[a] - np.cumsum(times), times) + np.arange(times.sum())]
        cut = [np.append(np.searchsorted(v, units), len(v)) for v in (a_unit, b_unit)]
        cut.append(np.concatenate([[0], np.cumsum(times)])[cut[0]])
        blobs = [(_packed, index[a], cut[0]), (np.ndarray.tobytes, lists, cut[2]), (_packed, query[b], cut[1])]
        region = np.searchsorted(base, units, "right") - 1
        alone = (across * down)[region] == 1
        for i in range(0, len(units), 16):
            some = slice(i, i + 16)
            m = len(units[some])
            yield pa.RecordBatch.from_arrays(
                [pa.array(units[some]), pa.array(np.full(m, dim, np.int32)), pa.array(region[some].astype(np.int32)), pa.array(alone[some]),
                 pa.array([v.dtype.str] * m), *(pa.array([pack(rows[at[k]:at[k + 1]]) for k in range(i, i + m)], pa.binary()) for pack, rows, at in blobs)],
                ["unit", "dim", "region", "alone", "kind", "index", "lists", "queries"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for _, v in _fine(batch):
                dim = v.shape[1]
                held.setdefault(dim, []).append(v)
                if sum(p.size for p in held[dim]) >= CHUNK_VALUES:
                    yield from flush(dim, held.pop(dim))
        for dim, parts in held.items():
            yield from flush(dim, parts)
    return run


class _Unit:
    """One unit: the vectors at home in a cell, compared with those that visit it."""

    def __init__(self, table: pa.Table, least: float):
        get = lambda name: table.column(name)[0].as_py()      # noqa: E731
        self.dim, self.region, self.alone, self.least = get("dim"), get("region"), get("alone"), least
        cat = lambda name, kind, read: np.concatenate([np.empty(0, kind), *(read(x.as_buffer(), kind) for x in table.column(name))])
        self.index, lists = cat("index", _index_type(self.dim, get("kind")), _unpacked), cat("lists", np.int32, np.frombuffer)
        self.queries = cat("queries", _query_type(self.dim), _unpacked)
        ends = np.cumsum(self.index["visits"], dtype=np.int64)
        # The same vector from several chunks becomes one.
        first, which = _first(self.index["key"])
        n = np.bincount(which, self.index["n"], len(first))
        self.index = self.index[first]
        at = np.repeat(np.arange(len(which)), np.diff(ends, prepend=0))
        once = np.zeros(len(which), bool)
        once[first] = True
        self.seen = np.sort(which[at[once[at]]] << 32 | lists[once[at]])           # (vector, lower cell it visits)
        first, which = _first(self.queries["key"])
        self.n = np.concatenate([n, np.bincount(which, self.queries["n"], len(first))]).astype(np.int64)
        self.queries = self.queries[first]
        self.u = _unit(self.index["x"]) if len(self.index) else np.empty((0, self.dim))
        self.x = self.u.astype(np.float32)
        self.h = len(self.index)
        self.key = np.concatenate([self.index["key"], self.queries["key"]])
        self.home = np.concatenate([np.full(self.h, self.region, np.int32), self.queries["home"]])
        self.links, self.root = np.zeros(len(self.key), np.int64), np.arange(len(self.key))
        self.pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0
        self.doubtful: list[pa.Table] = []

    def steps(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors of the places ``rows`` as float32, and how far they may be from the truth."""
        x, err = np.empty((len(rows), self.dim), np.float32), np.full(len(rows), 2e-6, np.float32)
        own = rows < self.h
        x[own] = self.x[rows[own]]
        q = self.queries[rows[~own] - self.h]
        x[~own], err[~own] = q["code"] * q["scale"][:, None], q["err"]
        return x, err

    def run(self) -> None:
        """Compares within finer cells, whose reach is set by an audit within the unit."""
        asking = np.arange(0 if self.alone else self.h, len(self.key))
        if not self.h or not len(asking):
            return
        fine = FINE * int(np.sqrt(self.h))
        cells = Cells.among(self.x[:2 * fine], fine if self.h > FINE_FROM else 1, self.least)
        if len(cells.centres) > 1:
            cells.reached(self.audit(cells, asking), RECALL ** 0.5)
        home = np.concatenate([s.argmax(axis=1) for _, s in cells.sims(self.x)])
        order = np.argsort(home, kind="stable")
        inside, ends = self.x[order], np.searchsorted(home[order], np.arange(len(cells.centres) + 1))
        block = max(Cells.BLOCK, QUERY_VALUES // self.dim)
        for i in range(0, len(asking), block):
            rows = asking[i:i + block]
            x, err = self.steps(rows)
            low = np.float32(self.least) - err - np.float32(1.2e-7 * self.dim)
            at, row, cell = cells.visits(x)
            row, cell = np.concatenate([np.arange(len(x), dtype=np.int32), row]), np.concatenate([at, cell])
            by = np.argsort(cell.astype(np.int16 if len(ends) < 1 << 15 else np.int32), kind="stable")
            row, starts = row[by], np.searchsorted(cell[by], np.arange(len(ends)))
            least = low.min()
            for c in np.flatnonzero((np.diff(starts) > 0) & (np.diff(ends) > 0)).tolist():
                some = row[starts[c]:starts[c + 1]]
                part = max(256, PAIRS // int(ends[c + 1] - ends[c]))
                for j in range(0, len(some), part):
                    r = some[j:j + part]
                    s = x[r] @ inside[ends[c]:ends[c + 1]].T
                    hit = np.flatnonzero(s >= least)
                    if len(hit):
                        a, b = np.divmod(hit, s.shape[1])
                        s, a = s.ravel()[hit], r[a]
                        ok = s >= low[a]
                        self.take(rows[a[ok]], order[ends[c] + b[ok]], s[ok])
            self.settle()

    def audit(self, cells: Cells, asking: np.ndarray) -> list[np.ndarray]:
        """As for the cells of the whole table: some of the vectors and queries, and probes
        at the threshold, against all vectors of the unit."""
        some = lambda rows: rows[np.linspace(0, len(rows) - 1, min(CELL_AUDITS, len(rows))).astype(int)]
        own = some(np.arange(self.h))
        visitors = some(asking[asking >= self.h]) if (asking >= self.h).any() else asking[:0]
        home = np.concatenate([s.argmax(axis=1) for _, s in cells.sims(self.x)])
        out = []
        for rows, q in ((own, self.x[own]), (visitors, self.steps(visitors)[0]), (own[:0], _probes(self.x[own], self.least))):
            counts = np.zeros((len(q), Cells.BINS + 1), np.int64)
            if len(q):
                links = q @ self.x.T >= self.least
                if len(rows):
                    links[:, own] &= (self.key[rows][:, None] != self.key[own][None]).any(axis=2)
                s = np.concatenate([s for _, s in cells.sims(q)])
                a, b = np.nonzero(links)
                np.add.at(counts, (a, cells.step(s[a], s.argmax(axis=1)[a], home[b])), 1)
            out.append(counts)
        return out

    def take(self, a: np.ndarray, b: np.ndarray, s: np.ndarray) -> None:
        self.pending.append((a, b, s))
        self.held += len(a)
        if self.held >= 1 << 18:
            self.settle()

    def settle(self) -> None:
        """Counts the pending pairs (query, vector at home, similarity)."""
        if not self.pending:
            return
        a, b, s = (np.concatenate(p) for p in zip(*self.pending))
        self.pending, self.held = [], 0
        ok = (self.key[a] != self.key[b]).any(axis=1)
        # A pair of two cells that visit each other's is counted in the lower of them.
        two = np.flatnonzero(ok & (self.home[a] < self.region))
        if len(self.seen) and len(two):
            want = b[two] << 32 | self.home[a[two]]
            ok[two] &= self.seen[np.minimum(np.searchsorted(self.seen, want), len(self.seen) - 1)] != want
        a, b, s = a[ok], b[ok], s[ok]
        # A cosine that its error cannot bring to the other side of the threshold is decided; else by doubles.
        exact = a < self.h
        err = np.full(len(a), 2e-6, np.float32)
        err[~exact] = self.queries["err"][a[~exact] - self.h]
        sure = s >= np.float32(self.least) + err + np.float32(1.2e-7 * self.dim)
        at = np.flatnonzero(exact & ~sure)
        for i in range(0, len(at), 1 << 15):
            p = at[i:i + (1 << 15)]
            sure[p] = np.einsum("kd,kd->k", self.u[a[p]], self.u[b[p]]) >= self.least
        rest = np.flatnonzero(~exact & ~sure)
        both = self.home[a] != self.region                     # vectors of one cell ask each other
        if len(rest):
            ka, kb = self.key[a[rest]], self.key[b[rest]]
            self.doubtful.append(_table(ka, kb, self.n[b[rest]], np.where(both[rest], self.n[a[rest]], 0)))
        a, b, both = a[sure], b[sure], both[sure]
        np.add.at(self.links, a, self.n[b])
        np.add.at(self.links, b[both], self.n[a[both]])
        while True:
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                break
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while (up := self.root[self.root] != self.root).any():
                self.root[up] = self.root[self.root[up]]

    def result(self) -> pa.Table:
        """Numbers of links (other key NULL), edges to the root of what is connected here, and pairs left open."""
        found, child = np.flatnonzero(self.links), np.flatnonzero(self.root != np.arange(len(self.root)))
        return pa.concat_tables([_table(self.key[found], None, self.links[found], None), _table(self.key[child], self.key[self.root[child]], None, None),
                                 *self.doubtful])


def _table(key: np.ndarray, other: np.ndarray | None, n: np.ndarray | None, m: np.ndarray | None) -> pa.Table:
    """k, l: a key; k2, l2: another; n: links of the first; m: links of the other, if the pair stands or falls with its cosine."""
    none = pa.nulls(len(key), pa.int64())
    col = lambda v: none if v is None else pa.array(np.ascontiguousarray(v, np.int64))
    return pa.Table.from_arrays([col(key[:, 0]), col(key[:, 1]), col(None if other is None else other[:, 0]),
                                 col(None if other is None else other[:, 1]), col(n), col(m)], ["k", "l", "k2", "l2", "n", "m"])


def _compared(least: float):
    def run(table: pa.Table) -> pa.Table:
        unit = _Unit(table, least)
        unit.run()
        return unit.result()
    return run


def _cosines(kind: str, least: float):
    """Pairs left open whose cosine in doubles reaches the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                a, b = (_unit(np.frombuffer(b"".join(batch.column(c).take(pa.array(rows)).to_pylist()), kind).reshape(-1, dim)) for c in ("x", "y"))
                ok[rows] = np.einsum("kd,kd->k", a, b) >= least
            yield batch.select(["k", "l", "k2", "l2", "n", "m"]).filter(pa.array(ok))
    return run


# ---------------------------------------------------------------- the operator

def _model(sample: list, kind: str, shards: int, least: float) -> dict:
    """Cells and audited queries of each length of vectors."""
    model = {}
    for dim in sorted({r["dim"] for r in sample}):
        own = [r for r in sample if r["dim"] == dim]
        x = _unit(np.frombuffer(b"".join(r["x"] for r in own), kind).reshape(-1, dim)).astype(np.float32)
        cells = Cells.among(x, -(-shards * len(own) // len(sample)), least)
        key = np.array([(r["k"], r["l"]) for r in own], np.int64)[-CELL_AUDITS:]
        q = np.concatenate([x[-CELL_AUDITS:], _probes(x[-CELL_AUDITS:], least)])
        s = np.concatenate([s for _, s in cells.sims(q)])
        model[dim] = {"cells": cells, "x": x, "key": key, "q": q, "s": s, "home": s.argmax(axis=1)}
    return model


def _laid_out(model: dict, rows: int, n: int) -> int:
    """Units of each cell: ``down`` parts of its vectors times ``across`` parts of its
    queries, by the sample's homes and visits. Returns their number."""
    total = 1                                                 # unit 0: lengths that the sample has none of
    for dim, m in model.items():
        home, _, cell = m["cells"].visits(m["x"])
        k, each = len(m["cells"].centres), n / rows
        inside = np.bincount(home, minlength=k)
        m["down"] = -(-inside * each * dim // INDEX_VALUES).astype(np.int64).clip(None, -1)
        m["across"] = -(-(inside + np.bincount(cell, minlength=k)) * each * dim // VISIT_VALUES).astype(np.int64).clip(None, -1)
        sizes = m["down"] * m["across"]
        m["base"] = total + np.cumsum(sizes) - sizes
        total += int(sizes.sum())
    return total


def near_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
               shard_rows: int = SHARD_ROWS, min_shards: int = MIN_SHARDS) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    spark = shipped(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    single = dict(rows.dtypes)["v"] == "array<float>"
    rows, kind = rows if single else rows.withColumn("v", F.col("v").cast("array<double>")), "<f4" if single else "<f8"
    placed = written(rows.mapInArrow(_placed, "id long, k long, l long"), "embed_keys")
    nodes = written(placed.where("k IS NOT NULL").groupBy("k", "l").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies")), "embed_nodes")
    n = nodes.count()
    shards = max(min_shards, -(-n // shard_rows))
    # Keys are spread evenly, so the lowest are a sample: from it come the centres, the audited queries and the sizes of the cells.
    share = min(1.0, (4 * shards + 2048) / max(1, n))
    most = int((1 << 63) * (2 * share - 1)) if share < 1 else (1 << 63) - 1
    sample = rows.mapInArrow(_vectors(most), "k long, l long, dim int, x binary").dropDuplicates(["k", "l"]).collect()
    sample = sorted(sample, key=lambda r: (r["l"], r["k"]))
    model = _model(sample, kind, shards, threshold)
    if any(len(m["cells"].centres) > 1 for m in model.values()):
        audit = rows.mapInArrow(_audited({d: {k: v for k, v in m.items() if k != "x"} for d, m in model.items()}, threshold),
                                "dim int, q int, step int, links long").groupBy("dim", "q", "step").agg(F.sum("links")).collect()
        for dim, m in model.items():
            counts = np.zeros((len(m["q"]), Cells.BINS + 1), np.int64)
            for _, q, step, links in (r for r in audit if r["dim"] == dim):
                counts[q, step] = links
            m["cells"].reached([counts[:len(m["key"])], counts[len(m["key"]):]], RECALL ** 0.5)
    units = _laid_out(model, len(sample) or 1, n)
    model = {d: {k: m[k] for k in ("cells", "base", "across", "down")} for d, m in model.items()}
    dealt = rows.mapInArrow(_dealt(model), "unit long, dim int, region int, alone boolean, kind string, index binary, lists binary, queries binary")
    found = (dealt.repartition(min(units, 4096), "unit", "dim").groupBy("unit", "dim")
                  .applyInArrow(_compared(threshold), "k long, l long, k2 long, l2 long, n long, m long"))
    found = written(found, "embed_found")
    linked = found.where("m IS NULL")
    doubtful = found.where("m IS NOT NULL")
    if not doubtful.isEmpty():
        wanted = written(doubtful.select("k", "l").unionByName(doubtful.select(F.col("k2").alias("k"), F.col("l2").alias("l"))).distinct(), "embed_wanted")
        have = written(rows.mapInArrow(_vectors(), "k long, l long, dim int, x binary").join(small_side(wanted), ["k", "l"])
                           .groupBy("k", "l").agg(F.first("dim").alias("dim"), F.first("x").alias("x")), "embed_have")
        other = have.select(F.col("k").alias("k2"), F.col("l").alias("l2"), F.col("x").alias("y"))
        pairs = doubtful.join(have, ["k", "l"]).join(other, ["k2", "l2"]).select("k", "l", "k2", "l2", "n", "m", "dim", "x", "y")
        pairs = written(pairs.mapInArrow(_cosines(kind, threshold), "k long, l long, k2 long, l2 long, n long, m long"), "embed_cosines")
        linked = (linked.unionByName(pairs.select("k", "l", F.lit(None).cast("long").alias("k2"), F.lit(None).cast("long").alias("l2"), "n", "m"))
                        .unionByName(pairs.where("m > 0").select(F.col("k2").alias("k"), F.col("l2").alias("l"), F.lit(None).cast("long").alias("k2"),
                                                                 F.lit(None).cast("long").alias("l2"), F.col("m").alias("n"), "m"))
                        .unionByName(pairs.select("k", "l", "k2", "l2", F.lit(None).cast("long").alias("n"), "m")))
    counts = linked.where("n IS NOT NULL").groupBy("k", "l").agg(F.sum("n").alias("links"))
    ids = nodes.select("k", "l", F.col("node").alias("a"))
    other = nodes.select(F.col("k").alias("k2"), F.col("l").alias("l2"), F.col("node").alias("b"))
    edges = linked.where("n IS NULL").select("k", "l", "k2", "l2").join(ids, ["k", "l"]).join(other, ["k2", "l2"]).select("a", "b")
    roots = written(connected(edges), "embed_roots")
    nodes = nodes.join(counts, ["k", "l"], "left").join(roots, "node", "left")
    nodes = written(nodes.select("k", "l", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
                                 F.coalesce("root", "node").alias("root")), "embed_placed")
    joined = placed.join(nodes, ["k", "l"], "left")
    component = F.coalesce("root", "id")
    return joined.select("id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         component.eqNullSafe(F.col("id")).alias("kept"))
