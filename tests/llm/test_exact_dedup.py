"""Exact dedup against a brute-force grouping."""

import hashlib
import re

from llm_data import awkward, documents

from batchgate.llm import exact_dedup


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, t or ""))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        out += [(i, keep, len(members), i == keep, hashlib.sha256(norm.encode()).hexdigest()) for i, _ in members]
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    rows = awkward()
    got = exact_dedup.exact_dedup(documents(spark, rows)).select("id", "keep_id", "group_size", "kept", "sha").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute([r[:2] for r in rows])


def test_prefix_ties_are_read_in_full(spark):
    # Equal length and equal first characters, told apart by the full hash only.
    rows = [(i, "p" * 300 + f"{i % 3:05d}") for i in range(9)]
    got = exact_dedup.exact_dedup(documents(spark, rows), prefix_chars=16).collect()
    assert sorted((r["id"], r["keep_id"]) for r in got) == [(i, i % 3) for i in range(9)]


def test_dropping_keeps_one_row_with_its_columns(spark):
    rows = awkward()
    docs = documents(spark, rows)
    out = exact_dedup.drop_exact_duplicates(docs)
    assert out.columns == docs.columns
    kept = sorted((r["doc_id"] for r in out.collect()), key=repr)
    want = brute([r[:2] for r in rows])
    assert kept == sorted({keep for _, keep, *_ in want}, key=repr)


def test_empty_table(spark):
    docs = documents(spark, [(1, "a")]).limit(0)
    assert exact_dedup.exact_dedup(docs).count() == 0
    assert exact_dedup.drop_exact_duplicates(docs).count() == 0


def test_one_row_stays_where_an_id_repeats_a_text(spark):
    rows = [(5, "a b"), (5, "a  b"), (5, "ab"), (6, "ab"), (None, "x y"), (None, "xy"), (None, "z"), (7, "z")]
    out = exact_dedup.drop_exact_duplicates(documents(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=repr) == sorted([(5, "a  b"), (None, "x y"), (7, "z")], key=repr)


def test_prefixes_are_hashed_of_repeated_lengths_only(spark, monkeypatch):
    sizes = {}

    def recorded(df, name, plain=exact_dedup.written):
        out = plain(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(exact_dedup, "written", recorded)
    rows = [(i, "x" * i) for i in range(30)] + [(100, "y" * 7), (101, "x" * 9)]
    exact_dedup.exact_dedup(documents(spark, rows)).collect()
    assert sizes["dedup_lengths"] == 2 and sizes["dedup_keys"] == 4 and sizes["dedup_survivors"] == 2
