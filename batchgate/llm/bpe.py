"""Byte-level BPE encoding and decoding with DuckDB recursive queries per partition.

Encoding. The tokenizer's pattern cuts a text into words; each partition keeps
the distinct words it has met lately. New words go into DuckDB, one token per
byte. Each round of a recursive query takes the live words apart into
token-position rows (word, position, token, next token), joins them with the
merge table (left token, right token -> rank) and contracts each word's
leftmost pair of minimum rank; a word without such a pair is done, and the
recursion ends when none is live. As in tiktoken, a word that is itself in the
vocabulary is that token.

Decoding. Token rows (document, place, id) join the vocabulary, and an
aggregate over the rows in order of their places puts the bytes of each document together.

A recursion contracts one pair a round, so its work grows with the square of
a word's length. Words of more than ``LONG`` bytes (a run of one character
class without a break) are contracted by the same rule on a heap instead.

Defined results
  * NULL text counts as empty: no tokens, empty decoded bytes. NULL ids decode
    to empty bytes. Text that looks like a special token is ordinary text.
  * Repeated rows get equal results; empty tables give empty results; other
    columns are ignored.

The vocabulary is a parameter (path of a rank file). It is read on the driver
and broadcast: its size is that of the file, whatever the data.
"""

from __future__ import annotations

import base64
import heapq
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchgate.llm.common import shipped

LONG = 64
WORDS_A_QUERY = 20_000
KEPT_WORDS = 250_000
SLICE_BYTES = 4 << 20
DECODE_TOKENS = 1 << 18             # token rows that one decoding query sorts

CONTRACT = """
WITH RECURSIVE step(w, ids, live) AS (
    SELECT w, ids, true FROM start
    UNION ALL
    SELECT s.w,
           CASE WHEN b.best IS NULL THEN s.ids
                ELSE list_concat(list_append(s.ids[:(b.best % 65536 - 1)], b.best // 65536), s.ids[(b.best % 65536 + 2):]) END,
           b.best IS NOT NULL
    FROM step s
    LEFT JOIN (SELECT t.w, min(m.rank * 65536 + t.pos) AS best
               FROM (SELECT w, unnest(range(1, len(ids))) AS pos, unnest(ids[:-2]) * 1073741824 + unnest(ids[2:]) AS pair
                     FROM step WHERE live) t
               JOIN merges m ON m.pair = t.pair
               GROUP BY t.w) b ON b.w = s.w
    WHERE s.live)
SELECT w, ids FROM step WHERE NOT live ORDER BY w
"""
# The aggregate takes its rows in the order of the subquery: the connection has one thread and keeps the order of rows.
# (An ORDER BY inside the aggregate sorts each document by itself, at three times the cost.)
DECODE = """
SELECT d, string_agg(text, '') AS text
FROM (SELECT t.d, v.text FROM tokens t JOIN vocabulary v ON v.id = t.id ORDER BY t.at) GROUP BY d
"""


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file, by id."""
    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, f))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError(f"ranks of {path} are not 0, 1, 2, ...")
    return [token for _, token in pairs]


class Vocabulary:
    """Ranks, the merge table, and a DuckDB connection for the time of a task."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.byte_id = np.array([self.rank[bytes([b])] for b in range(256)])
        self.merges: pa.Table | None = None
        self.db = None
        self.loaded: set[str] = set()

    def _merges(self) -> pa.Table:
        """Both tokens of a pair as one number, and the rank of the pair."""
        if self.merges is None:
            pairs = [(self.rank[t[:k]], self.rank[t[k:]], i) for i, t in enumerate(self.tokens)
                     for k in range(1, len(t)) if t[:k] in self.rank and t[k:] in self.rank]
            left, right, rank = np.array(pairs, np.int64).reshape(-1, 3).T
            self.merges = pa.table({"pair": (left << 30) + right, "rank": rank})
        return self.merges

    def _vocabulary(self) -> pa.Table:
        """Bytes as characters of equal number; 0 has character 256."""
        texts = [t.decode("latin-1").replace("\0", "Ā") for t in self.tokens]
        return pa.table({"id": pa.array(range(len(texts)), pa.int32()), "text": texts})

    def _open(self, table: str):
        """The connection, with ``table`` (merges or vocabulary) loaded: encoding
        needs the one, decoding the other."""
        import duckdb

        if self.db is None:
            self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "preserve_insertion_order": True})
        if table not in self.loaded:
            rows = self._merges() if table == "merges" else self._vocabulary()
            self.db.execute(f"CREATE TABLE {table} AS SELECT * FROM rows")
            self.loaded.add(table)
            del rows
        return self.db

    def close(self) -> None:
        """Gives the connection's memory back: an idle worker holds the ranks and the pairs only."""
        if self.db is not None:
            self.db.close()
        self.db, self.loaded = None, set()

    # ---- words to ids

    def contract(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words by the recursive query."""
        return [np.frombuffer(x, np.int32) for x in self._contract(words)]

    def _contract(self, words: list[bytes]) -> list[bytes]:
        """The same as the bytes of int32 arrays."""
        ends = np.cumsum([0, *map(len, words)])
        raw = np.frombuffer(b"".join(words), np.uint8)
        start = pa.table({"w": np.arange(len(words)),
                          "ids": pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(self.byte_id[raw]))})
        ids = self._open("merges").sql(CONTRACT).to_arrow_table().column("ids").combine_chunks()
        del start
        values = ids.values.to_numpy(zero_copy_only=False).astype(np.int32).tobytes()
        cut = (ids.offsets.to_numpy().astype(np.int64) * 4).tolist()
        return [values[a:b] for a, b in zip(cut, cut[1:])]

    def contract_long(self, word: bytes) -> np.ndarray:
        """The same contraction on a heap of (rank, position), for one long word."""
        tok = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        part = [bytes([b]) for b in word]
        after, before = list(range(1, len(tok) + 1)), list(range(-1, len(tok) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def push(i: int) -> None:
            j = after[i]
            if j < len(tok) and (r := self.rank.get(part[i] + part[j])) is not None:
                heapq.heappush(heap, (r, i, tok[i], tok[j]))

        for i in range(len(tok) - 1):
            push(i)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if tok[i] >= 0 else len(tok)
            if j >= len(tok) or tok[i] != a or tok[j] != b:
                continue
            tok[i], part[i], tok[j] = r, part[i] + part[j], -1
            after[i] = after[j]
            if after[i] < len(tok):
                before[after[i]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([t for t in tok if t >= 0])

    def encode_words(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each word and its ids (as the bytes of an int32 array)."""
        todo: list[str] = []
        raws: list[bytes] = []
        for word in words:
            raw = word.encode()
            if raw in self.rank:
                yield word, self.rank[raw].to_bytes(4, sys.byteorder)
            elif len(raw) > LONG:
                yield word, self.contract_long(raw).astype(np.int32).tobytes()
            else:
                todo.append(word)
                raws.append(raw)
        for k in range(0, len(todo), WORDS_A_QUERY):
            yield from zip(todo[k:k + WORDS_A_QUERY], self._contract(raws[k:k + WORDS_A_QUERY]))

    # ---- ids to bytes

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Bytes of the documents whose ids end at ``ends`` in one flat array."""
        lengths = np.diff(ends, prepend=0)
        tokens = pa.table({"d": np.repeat(np.arange(len(ends), dtype=np.int32), lengths), "id": ids.astype(np.int32),
                           "at": np.arange(len(ids), dtype=np.int32)})
        found = self._open("vocabulary").sql(DECODE).to_arrow_table()
        del tokens
        out = [b""] * len(ends)
        for d, text in zip(found.column("d").to_pylist(), found.column("text").to_pylist()):
            out[d] = text.replace("Ā", "\0").encode("latin-1")
        return out


class Encoder:
    """Texts to ids. Words met lately are kept in two generations of about
    ``KEPT_WORDS``; a full one replaces the older, so frequent words stay."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import regex

        self.vocabulary, self.split = vocabulary, regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        words = [self.split(t) for t in texts]
        if len(self.known) > KEPT_WORDS:
            self.known, self.older = {}, self.known
        new = set().union(*words) - self.known.keys()
        for w in new & self.older.keys():
            self.known[w] = self.older[w]
        self.known.update(self.vocabulary.encode_words(list(new - self.older.keys())))
        ids = self.known.__getitem__
        return [np.frombuffer(b"".join(map(ids, ws)), np.int32) for ws in words]


_HELD: dict[str, Vocabulary] = {}


def _vocabulary(tokens: list[bytes], name: str) -> Vocabulary:
    """The worker's vocabulary; a worker process serves many tasks."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = Vocabulary(tokens)
    return _HELD[name]


def _parts(column: pa.Array, least: int) -> Iterator[tuple[int, list]]:
    """Runs of rows that hold about ``least`` characters or ids."""
    start, size, held = 0, 0, []
    for i, x in enumerate(column):
        held.append(x)
        size += len(x.as_buffer()) if isinstance(x, pa.StringScalar) and x.is_valid else len(x) if x.is_valid else 0
        if size >= least:
            yield start, held
            start, size, held = i + 1, 0, []
    if held:
        yield start, held


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, pattern: str) -> Iterator[pa.RecordBatch]:
    """Batches of (id, text) as batches of (id, ids)."""
    encoder = Encoder(vocabulary, pattern)
    for batch in batches:
        for start, held in _parts(batch.column(1), SLICE_BYTES):
            ids = encoder([x.as_py() for x in held])
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids), pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(held)), ids], names=["id", "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, ids_col: str, out_col: str) -> Iterator[pa.RecordBatch]:
    """Batches with the decoded bytes of their ids as one more column."""
    for batch in batches:
        for start, held in _parts(batch.column(ids_col), DECODE_TOKENS):
            column = batch.column(ids_col).slice(start, len(held))
            ends = np.cumsum([len(x) if x.is_valid else 0 for x in held])
            texts = vocabulary.decode(column.flatten().to_numpy(zero_copy_only=False), ends)
            yield pa.RecordBatch.from_arrays([*(c.slice(start, len(held)) for c in batch.columns), pa.array(texts, pa.binary())],
                                             names=[*batch.schema.names, out_col])


def _task(rows: DataFrame, path: str, schema: T.StructType, work: Callable) -> DataFrame:
    """``work`` on the batches of each task with the vocabulary, closed with the task."""
    shared = shipped(rows.sparkSession).sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared.value, path)
        try:
            yield from work(batches, vocabulary)
        finally:
            vocabulary.close()

    return rows.mapInArrow(run, schema)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[T.StructField]]:
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows, [T.StructField("id", rows.schema["id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ids (array of int) of every row."""
    rows, fields = _texts(docs, id_col, text_col)
    return _task(rows, path, T.StructType(fields), lambda batches, v: _encoded(batches, v, pattern))


def decode(rows: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with the decoded bytes of their ids."""
    schema = T.StructType([*rows.schema.fields, T.StructField(out_col, T.BinaryType())])
    return _task(rows, path, schema, lambda batches, v: _decoded(batches, v, ids_col, out_col))


def encode_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids and the bytes decoded from them: :func:`encode`, then :func:`decode`, in
    one worker a task (chained as frames they run in two, with two vocabularies)."""
    rows, fields = _texts(docs, id_col, text_col)
    schema = T.StructType([*fields, T.StructField("decoded", T.BinaryType())])
    return _task(rows, path, schema, lambda batches, v: _decoded(_encoded(batches, v, pattern), v, "ids", "decoded"))
