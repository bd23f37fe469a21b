"""Byte-level BPE against the tiktoken library, and exact round trips."""

import base64
import random

import public_tokenizers as P
import pytest
import tiktoken
from llm_data import awkward, documents

from batchgate.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_awkward_rows(spark, library):
    rows = awkward() + [(300, "<|endoftext|> 's  \x85 \t\n  x"), (301, "a" * 20_000), (302, "1234567 don't WE'LL")]
    out = bpe.decode(bpe.encode(documents(spark, rows), PATH, P.PATTERN), PATH).collect()
    want = sorted(((i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in rows), key=repr)
    assert sorted(((r["id"], list(r["ids"]), bytes(r["decoded"])) for r in out), key=repr) == want


def test_both_ways_in_one_worker(spark, library):
    rows = awkward() + [(301, "a" * 20_000), (302, "1234567 don't WE'LL")]
    out = bpe.encode_decode(documents(spark, rows), PATH, P.PATTERN)
    want = sorted(((i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in rows), key=repr)
    assert sorted(((r["id"], list(r["ids"]), bytes(r["decoded"])) for r in out.collect()), key=repr) == want
    assert bpe.encode_decode(documents(spark, rows).limit(0), PATH, P.PATTERN).count() == 0


def test_connection_closes_and_opens_again(library):
    vocabulary = bpe.Vocabulary(bpe.read_ranks(PATH))
    for _ in range(2):
        assert [x.tolist() for x in vocabulary.contract([b"zqxzq", b"unfoldable"])] == [
            library.encode_ordinary("zqxzq"), library.encode_ordinary("unfoldable")]
        vocabulary.close()
        assert vocabulary.db is None


def test_empty_table(spark):
    docs = documents(spark, [(1, "a")]).limit(0)
    assert bpe.decode(bpe.encode(docs, PATH, P.PATTERN), PATH).count() == 0


def test_null_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(1, [36, 13]), (2, None), (3, [])], "k long, ids array<int>")
    got = {r["k"]: bytes(r["decoded"]) for r in bpe.decode(rows, PATH).collect()}
    assert got[2] == b"" and got[3] == b"" and len(got[1]) >= 2


def test_recursion_and_heap_agree(library):
    vocabulary = bpe.Vocabulary(bpe.read_ranks(PATH))
    rng = random.Random(1)
    words = [bytes(rng.choice(b"abcdeinrst\xc3\xa9") for _ in range(rng.randrange(2, 64))) for _ in range(800)] + [b"ab" * 30, b"a" * 64]
    assert [x.tolist() for x in vocabulary.contract(words)] == [vocabulary.contract_long(w).tolist() for w in words]


def test_words_are_kept_in_generations(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 20)
    encoder = bpe.Encoder(bpe.Vocabulary(bpe.read_ranks(PATH)), P.PATTERN)
    rng = random.Random(2)
    for _ in range(12):
        texts = [" ".join(f"zq{rng.randrange(60)}x" for _ in range(30)) for _ in range(3)]
        assert [x.tolist() for x in encoder(texts)] == [library.encode_ordinary(t) for t in texts]
