"""WARC: round trips, revisits, and magic inside payloads."""

import hashlib

import pytest
from pyspark.sql import functions as F

from batchgate.llm import warc
from batchgate.session import scratch_path

FAKE = ("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")


def round_trip(spark, rows, **kw):
    path = scratch_path(spark, "test", "warc")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit("x") for c in ("id", "digest", "payload", "value", "first", "path", "at", "next")})
    warc.write_archives(pages, path, **kw)
    return path, sorted((tuple(r) for r in warc.read_pages(spark, path).collect()), key=repr)


def brute(rows):
    first, out = {}, []
    for i, _, h in rows:
        h = h or ""
        if i is not None:
            first[h] = min(first.get(h, i), i)
    for i, _, h in rows:
        h = h or ""
        b = h.encode()
        again = len(b) >= 100 and h in first and i != first[h]
        out.append((str(i) if i is not None else "null", len(b), hashlib.sha256(b).hexdigest(),
                    "revisit" if again else "response", str(first[h]) if again else None))
    return sorted(out, key=repr)


ROWS = [(1, "http://a/", "x" * 200), (2, None, "x" * 200), (3, "http://b/\r\nInjected: 1", "short"), (4, "", "short"), (5, "u", None),
        (6, "u", ""), (7, "u", FAKE), (8, "u", FAKE * 40 + "WARC/1.1\r\n"), (9, "u", "\r\n\r\nWARC/1.1\r\n" + FAKE + "\r\n\r\n"),
        (10, "u", "é漢\U0001f600" * 100), (11, "u", "y" * 300_000), (None, "u", "x" * 200), (None, None, None), (0, "u", "x" * 200),
        (12, "u", "Content-Length: 5\r\n\r\n"), (12, "u", "Content-Length: 5\r\n\r\n")]


@pytest.mark.parametrize("file_bytes", [1, 2000, 16 << 20])
def test_round_trip_with_magic_in_payloads(spark, file_bytes):
    _, got = round_trip(spark, ROWS, file_bytes=file_bytes)
    assert got == brute(ROWS)


def test_long_urls(spark):
    url = "data:text/html," + "u" * 100_000
    rows = [(1, url, "a"), (2, url + FAKE, FAKE), (3, "u", "x" * 200), (4, url * 20, "x" * 200), (5, "u", "b")]
    _, got = round_trip(spark, rows)
    assert got == brute(rows)


def test_lines_of_magic_are_read_once():
    body = b"a:WARC/1.1\r\n" * 200_000
    data = b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body)
    assert [c[:2] for c in warc.candidates_of(data)] == [(0, len(data))]


def test_empty_table(spark):
    path = scratch_path(spark, "test", "warc")
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(empty, path)
    assert warc.read_pages(spark, path).count() == 0


def test_candidates_and_reachable(spark):
    body = (FAKE + FAKE).encode()
    outer = b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body)
    data = outer * 3
    found = [c[:2] for c in warc.candidates_of(data)]
    assert len(found) == 9
    links = spark.createDataFrame([("f", *c) for c in found], "path string, at long, next long")
    reached = sorted(r["at"] for r in warc.reachable(links).collect())
    assert reached[:3] == [0, len(outer), 2 * len(outer)] and set(reached) <= {0, len(outer), 2 * len(outer), 3 * len(outer)}


def test_a_broken_chain_raises(spark):
    path = scratch_path(spark, "test", "warc")
    spark.createDataFrame([(FAKE + "junk that is no record",)], "value string").coalesce(1).write.text(path)
    with pytest.raises(ValueError, match="stops before"):
        warc.read_records(spark, path)
