"""Periodic runs against a word-by-word brute force, and the planted query."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest
from llm_data import awkward, documents

from batchgate.llm import periodic_runs
from batchgate.llm.queries import op13_periodic_runs

SF = "/root/testdata/sf0.001"


def brute(words, min_words=24, min_repeats=3):
    """Every maximal match of every lag, kept if no smaller period holds in it."""
    n, out = len(words), []
    for q in range(1, n // min_repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(min_words, min_repeats * q):
                part = words[i:i + size]
                if not any(part[:size - p] == part[p:] for p in range(1, q)):
                    out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(words):
    runs = brute(words)
    top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (len(runs), *best, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(kept).encode()).hexdigest())


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


def planted(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def test_runs_of_random_sequences():
    rng, seen = random.Random(3), 0
    for _ in range(800):
        letters = rng.choice([1, 2, 2, 3, 5])
        words = [rng.randrange(letters) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(4)):
            block = [rng.randrange(letters) for _ in range(rng.randrange(1, 60))]
            words += (block * 6)[:int(len(block) * rng.uniform(1, 5))]
        least, repeats = rng.choice([(24, 3), (24, 3), (10, 3), (7, 4), (2, 3), (40, 5)])
        want = brute(words, least, repeats)
        seen += len(want)
        assert periodic_runs.runs_of(np.array(words, dtype=np.int64), least, repeats) == want
    assert seen > 1000


def test_the_seed_of_a_run_is_not_hidden_by_repeats_inside_its_period():
    """Each 16-gram of this period occurs more than once in it, so the lag is found by longer k-grams only."""
    rng = random.Random(5)
    a, b = ([rng.randrange(9) for _ in range(40)] for _ in range(2))
    block = a + a + b + b + a + b
    assert brute(block * 3) == periodic_runs.runs_of(np.array(block * 3, dtype=np.int64)) != []
    assert (0, 720, 240) in brute(block * 3)


def test_one_word_a_hundred_thousand_times_is_one_extension():
    assert periodic_runs.runs_of(np.zeros(100_000, dtype=np.int64)) == [(0, 100_000, 1)]


def test_fewer_than_three_repeats_are_refused(spark):
    with pytest.raises(ValueError):
        periodic_runs.find_runs(documents(spark, [(1, "a")]), min_repeats=2)


def test_awkward_rows(spark):
    rows = awkward() + [(300, "ab " * 24), (300, "ab " * 24), (301, " \n".join("x y z".split() * 8)), (302, "ab " * 23),
                        (303, "é ñ é ñ " * 12), (304, "a\xa0b a\xa0b " * 12)]
    docs = documents(spark, rows)
    got = [(r["id"], [tuple(x) for x in r["runs"]], bytes(r["collapsed"]).decode()) for r in periodic_runs.find_runs(docs).collect()]
    want = []
    for doc_id, text, *_ in rows:
        words = words_of(text)
        runs = brute(words) if len(words) < 2000 else []
        want.append((doc_id, runs, " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs))))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0


def test_long_rows_leave_in_small_batches(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "SLICE_BYTES", 100)
    rows = [(i, f"w{i} " * 30) for i in range(40)]
    got = periodic_runs.find_runs(documents(spark, rows)).collect()
    assert sorted(r["id"] for r in got) == list(range(40)) and all(len(r["runs"]) == 1 for r in got)


def test_query_against_brute_force(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in op13_periodic_runs(spark, SF).collect()}
    table = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    assert len(got) == len(table)
    short = [(r["doc_id"], planted(r["doc_id"], words_of(r["text"]))) for r in table]
    short = [(i, w) for i, w in short if len(w) < 3000]
    assert len(short) > 150 and all(got[i] == brute_row(w) for i, w in short)
    assert sum(got[i][0] > 0 for i, _ in short) > 10
