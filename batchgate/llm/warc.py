r"""WARC archives: written by Spark, read back by boundary-chain verification.

Writing. One record per page; of records with equal payloads of at least
``min_revisit`` bytes the one with the smallest id is the response, the others
are revisits without a body. Records go through Spark's text writer, whose
line separator ``\r\n\r\n`` is the end of a WARC record, so files are committed
by Spark's protocol and a lost executor leaves none half written. Files are
bounded by a record count that aims at ``file_bytes``.

Reading. A task scans a file for the magic ``WARC/1.1`` and emits every
candidate with the offset that its header claims for its successor. A payload
may hold the magic, even whole records; so pointer jumping from offset 0 (each
round doubles the distance: reached offsets follow the jumps, jumps are joined
with themselves) keeps only the candidates that a chain from the start of the
file reaches. A chain that stops before the end of its file raises.

Defined results
  * NULL payload is empty. Payloads below ``min_revisit`` bytes are always
    responses. Rows that repeat id and payload are records of one page and
    share its decision. A NULL id is kept as such; it refers to the smallest id.
  * Empty tables give empty archives and results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchgate.llm.common import shipped, written

MAGIC = b"WARC/1.1\r\n"
END = "\r\n\r\n"
MIN_REVISIT = 100
FILE_BYTES = 16 << 20
BROADCAST_ROWS = 200_000         # revisits of some 100 bytes each: 20 MB
_FIELDS = {"content-length", "warc-type", "warc-record-id", "warc-refers-to", "warc-payload-digest"}
_DATE = "2000-01-01T00:00:00Z"


def revisits(pages: DataFrame, id_col: str, payload_col: str, min_revisit: int) -> tuple[DataFrame, int]:
    """(id, digest, first id) of the records that revisit another, and the mean payload bytes."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = written(pages.select(F.col(id_col).alias("id"), F.sha2(payload, 256).alias("digest"),
                                F.octet_length(payload).cast("long").alias("bytes")), "warc_digests")
    mean = rows.agg(F.coalesce(F.avg("bytes"), F.lit(0.0))).first()[0]
    groups = (rows.where(F.col("bytes") >= min_revisit).groupBy("digest")
                  .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).where("n > 1").drop("n"))
    groups = written(groups, "warc_groups")
    again = rows.join(groups, "digest").where("NOT (id <=> first)").select("id", "digest", "first").distinct()
    return written(again, "warc_revisits"), int(mean)


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", payload_col: str = "html", url_col: str | None = "url",
                   min_revisit: int = MIN_REVISIT, file_bytes: int = FILE_BYTES) -> None:
    """Writes ``pages`` as WARC files under ``path``."""
    again, mean = revisits(pages, id_col, payload_col, min_revisit)
    rows = pages.select(F.col(id_col).alias("id"), (F.col(url_col) if url_col else F.lit(None)).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).alias("p")
    # Payloads are shuffled only if the revisits are too many to be broadcast.
    side = F.broadcast(again) if again.count() <= BROADCAST_ROWS else again
    rows = rows.join(side.alias("r"), F.expr("p.id <=> r.id AND p.digest = r.digest"), "left")
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))                            # noqa: E731
    revisit = F.col("r.first").isNotNull()
    full = F.octet_length("payload").cast("string")
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    record = F.concat(
        F.lit(MAGIC.decode()), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn(F.col("p.id"))), line("WARC-Date", F.lit(_DATE)),
        F.coalesce(line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20]", "")), F.lit("")),
        F.when(revisit, line("WARC-Refers-To", urn(F.col("r.first")))).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("p.digest"))),
        line("X-Payload-Length", full), line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(full)), F.lit("\r\n"), body)
    per_file = max(1, file_bytes // (mean + 400))
    (rows.select(record.alias("value")).write.option("lineSep", END).option("compression", "none")
         .option("maxRecordsPerFile", per_file).text(path))


# --------------------------------------------------------------------- reading

class _Headers:
    """Headers of any length. Places that share the header's end (the first empty
    line after them) share its lines, which are read once."""

    def __init__(self, data: bytes):
        self.data, self.end = data, -1

    def at(self, at: int) -> tuple[dict[str, str], int] | None:
        """Fields of the header at ``at`` and the offset of its payload; places in
        ascending order."""
        if at > self.end:
            self.end = self.data.find(b"\r\n\r\n", at)
            if self.end < 0:
                self.end = len(self.data)                     # no header ends after this place
            else:
                self._read(at + len(MAGIC))
        if self.end == len(self.data):
            return None
        first = at + len(MAGIC)
        if self.bad >= first or first > self.end:
            return None
        fields = {k: v for k, (place, v) in self.fields.items() if place >= first}
        return (fields, self.end + 4) if fields.get("content-length", "").isdecimal() else None

    def _read(self, place: int) -> None:
        """The last place and value of each field, and the last line that is none."""
        self.fields, self.bad = {}, -1
        for line in self.data[place:self.end].split(b"\r\n"):
            name, colon, value = line.partition(b":")
            if not colon:
                self.bad = place
            elif (key := name.strip().lower().decode("latin-1")) in _FIELDS:
                self.fields[key] = place, value.strip().decode("utf-8", "replace")
            place += len(line) + 2


def candidates_of(data: bytes) -> Iterator[tuple]:
    """Every place that looks like a record: offset, successor, whether a record
    or the end of the file stands there, header fields, payload size and digest."""
    headers, at = _Headers(data), data.find(MAGIC)
    while at >= 0:
        if (found := headers.at(at)) is not None:
            fields, start = found
            stop = start + int(fields["content-length"])
            if data[stop:stop + 4] == b"\r\n\r\n":
                follows = stop + 4 == len(data) or data.startswith(MAGIC, stop + 4)
                digest = hashlib.sha256(memoryview(data)[start:stop]).hexdigest() if follows else None
                yield (at, stop + 4, fields.get("warc-type"), fields.get("warc-record-id", ""), fields.get("warc-refers-to"),
                       fields.get("warc-payload-digest", "").removeprefix("sha256:"), stop - start, digest, len(data))
        at = data.find(MAGIC, at + 1)


_CANDIDATE = ("path string, at long, next long, record_type string, record_id string, refers string, "
              "claimed string, payload_bytes long, digest string, file_bytes long")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _CANDIDATE.split(", ")]
    kinds = [pa.int64() if x.endswith("long") else pa.string() for x in _CANDIDATE.split(", ")]
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            rows = [(path.as_py(), *c) for c in candidates_of(content.as_py())]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def reachable(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(path, at) of the candidates that a chain from offset 0 reaches, by pointer
    jumping over ``links`` (path, at, next)."""
    reached = written(links.where(F.col("at") == 0).select("path", "at"), "warc_reached")
    jump = written(links.select("path", "at", "next"), "warc_jump")
    for _ in range(max_rounds):
        if jump.isEmpty():
            return reached
        ahead = reached.join(jump, ["path", "at"]).select("path", F.col("next").alias("at"))
        reached = written(reached.unionByName(ahead), "warc_reached")
        onward = jump.select("path", F.col("at").alias("next"), F.col("next").alias("far"))
        jump = written(jump.join(onward, ["path", "next"]).select("path", "at", F.col("far").alias("next")), "warc_jump")
    raise RuntimeError(f"the chains of the archives did not end in {max_rounds} rounds")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``."""
    files = shipped(spark).read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0")
    found = written(files.select("path", "content").mapInArrow(_scan, _CANDIDATE), "warc_candidates")
    starts = reachable(found.select("path", "at", "next"))
    # A chain may also step on an offset that is no candidate (or the end); the join leaves it out.
    records = written(found.join(starts, ["path", "at"], "left_semi"), "warc_records")
    ends = files.select("path", "length").join(
        records.groupBy("path").agg(F.max("next").alias("end")), "path", "left").where("end IS NULL OR end <> length")
    if (bad := ends.select("path").first()) is not None:
        raise ValueError(f"the record chain of {bad.path} stops before the end of the file")
    return records


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Per record: id (text), payload_bytes and payload_digest of the full payload,
    record_type, refers_to (id as text). A revisit's payload is its response's."""
    records = read_records(spark, path)
    bare = lambda c: F.regexp_extract(c, "^<urn:page:(.*)>$", 1)
    full = records.where("record_type = 'response'").select("record_id", "digest", "payload_bytes")
    first = full.distinct().select(F.col("record_id").alias("refers"), F.col("digest").alias("claimed"),
                                   F.col("payload_bytes").alias("full_bytes"))
    again = records.where("record_type = 'revisit'").select("record_id", "refers", "claimed")
    again = again.join(written(first, "warc_first"), ["refers", "claimed"], "left")
    return (full.select(bare(F.col("record_id")).alias("id"), "payload_bytes", F.col("digest").alias("payload_digest"),
                        F.lit("response").alias("record_type"), F.lit(None).cast("string").alias("refers_to"))
                .unionByName(again.select(bare(F.col("record_id")).alias("id"), F.col("full_bytes").alias("payload_bytes"),
                                          F.col("claimed").alias("payload_digest"), F.lit("revisit").alias("record_type"),
                                          bare(F.col("refers")).alias("refers_to"))))
