"""SimHash: fingerprints and components against brute force."""

import itertools
import random
import re

import numpy as np
import xxhash
from llm_data import awkward, documents, words

from batchgate.llm import components, simhash


def slow_fingerprint(text, shingle=4):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    s = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] if len(w) >= shingle else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def slow_components(ids, fps, bits=4):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, j in itertools.combinations(range(len(ids)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= bits:
            root[max(find(i), find(j))] = min(find(i), find(j))
    group = {}
    for i in range(len(ids)):
        group.setdefault(find(i), []).append(ids[i])
    least = {r: min((x for x in g if x is not None), default=None) for r, g in group.items()}
    return [least[find(i)] for i in range(len(ids))]


def compare(spark, rows):
    fps = [slow_fingerprint(t) for _, t, *_ in rows]
    want = sorted(((r[0], f, c) for r, f, c in zip(rows, fps, slow_components([r[0] for r in rows], fps))), key=repr)
    got = simhash.near_dedup(documents(spark, rows)).collect()
    assert sorted(((r["id"], r["fp"] % 2 ** 64, r["component_id"]) for r in got), key=repr) == want
    return want


def test_awkward_rows(spark):
    compare(spark, awkward())


def test_near_copies(spark):
    rng, rows = random.Random(2), []
    for g in range(20):
        base = words(rng, 300).split()
        for k in range(6):
            w = list(base)
            for _ in range(k):
                w[rng.randrange(len(w))] = f"edit{rng.randrange(99)}"
            rows.append((g * 10 + k, " ".join(w)))
    want = compare(spark, rows)
    assert len({c for *_, c in want}) < len(rows)


def test_every_four_positions_hold_a_triple():
    triples = [set(t) for t in simhash.turan_triples()]
    assert len(triples) == 20
    assert all(any(t <= set(four) for t in triples) for four in itertools.combinations(range(8), 4))


def test_links_of_dense_balls_with_hot_postings(spark, monkeypatch):
    # Fingerprints a few bits around a centre: long postings, cut into tiles.
    monkeypatch.setattr(simhash, "HOT", 100)
    monkeypatch.setattr(simhash, "CHUNK", 40)
    rng = random.Random(3)
    fps = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(250):
            x = centre
            for b in rng.sample(range(64), rng.randrange(6)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    frame = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    roots = {r["node"] % 2 ** 64: r["root"] for r in components.connected(simhash.near_links(frame)).collect()}
    want = slow_components(list(range(len(fps))), fps)
    for i, j in itertools.combinations(range(len(fps)), 2):
        assert (want[i] == want[j]) == (roots.get(fps[i], -i - 1) == roots.get(fps[j], -j - 1) and fps[i] in roots)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000), (6001, 6000), (6000, 6001)]
    got = {r["node"]: r["root"] for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(301)) and all(got[1000 + i] == 1000 for i in range(200))
    assert got[6001] == 6000 and 5000 not in got
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_table(spark):
    assert simhash.near_dedup(documents(spark, [(1, "a")]).limit(0)).count() == 0
