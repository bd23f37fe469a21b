"""Table sinks: append, overwrite, and the write-mode dispatch of a load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import as_of_column
from ..functions.predicates import null_safe
from ..operators.key_counts import KeyCounts
from ..operators.merge import BUCKET, bucket_expr, conform, merge_into, resolve_layout, target_schema
from ..session import TableRef


def _writer(df: DataFrame, ref: TableRef, mode: str):
    return df.write.mode(mode).format(ref.format)


def append_table(df: DataFrame, table: TableRef | dict | str) -> None:
    """Append rows (columns matched by name for catalog tables)."""
    ref = TableRef.of(table)
    if ref.name:
        _writer(df, ref, "append").saveAsTable(ref.name)
    else:
        # Files of another schema beside the old ones would be read back without an error, columns missing.
        if ref.exists(df.sparkSession):
            have = {x.name: x.dataType.simpleString() for x in ref.read(df.sparkSession).schema.fields}
            new = {x.name: x.dataType.simpleString() for x in df.schema.fields}
            if have != new:
                odd = sorted(c for c in {*have, *new} if have.get(c) != new.get(c))
                raise ValueError(f"Append to {ref.label} with another schema; columns that differ: {odd}")
        _writer(df, ref, "append").save(ref.path)


def append_once(df: DataFrame, table: TableRef | dict | str, done: Column, rows: int,
                as_of: dt.datetime | str | None = None) -> None:
    """Append a load's ``rows`` rows so that they stand in the table once, however often the load is run.

    ``done`` tells the load's own rows (:func:`batchgate.operators.merge.own_rows`);
    it reaches the scan as a pushed filter, so other loads' files are pruned by
    their statistics. All rows there: nothing to write. None: a plain append. Some
    (the first attempt died while its files were put in place): the missing
    rows are added, counted with their repeats and compared in all columns but
    the run time.
    """
    ref, spark = TableRef.of(table), df.sparkSession
    if not ref.exists(spark):
        return append_table(df, ref)
    own = ref.read(spark).filter(null_safe(done))
    found = own.count()
    if found >= rows:
        return None
    if found:
        cols = [c for c in df.columns if c != S.INGESTED_AT]
        left = df.select(*cols).exceptAll(own.select(*cols))
        df = left.withColumn(S.INGESTED_AT, as_of_column(as_of)).select(*df.columns) if S.INGESTED_AT in df.columns else left
    return append_table(df, ref)


def overwrite_table(df: DataFrame, table: TableRef | dict | str) -> None:
    """Replace all rows of the table."""
    ref = TableRef.of(table)
    if ref.name:
        _writer(df, ref, "overwrite").saveAsTable(ref.name)
    else:
        # Stated, since a concurrent merge may hold the session's mode at dynamic.
        _writer(df, ref, "overwrite").option("partitionOverwriteMode", "static").save(ref.path)


def write_target(spark: SparkSession, df: DataFrame, mode: str, master: TableRef,
                 raw: TableRef | None = None, keys: list[str] | None = None, *,
                 as_of: dt.datetime | str | None = None, buckets: int = 64,
                 batch_rows: int | None = None, batch_bytes: int | None = None,
                 dedupe_by: list[str] | None = None, layout: str | None = None,
                 counts: KeyCounts | None = None, done: Column | None = None) -> dict:
    """Write an enriched batch by mode; returns merge counters (or zeros).

    merge: the batch replaces the raw (staging) table, then is merged into the
    master. overwrite / append go to the master only. ``counts``: key counts
    of the batch; ``done``: the condition on target rows that this load has
    written before (each mode then leaves what one run would).
    """
    if mode == "merge":
        touched = None
        if raw is not None:
            # The raw table receives exactly the rows to merge: observe their
            # buckets on that write (at most `buckets` values), not in a new pass.
            layout = resolve_layout(TableRef.of(master), layout)
            obs = Observation("batchgate_buckets")
            stored = target_schema(spark, TableRef.of(master))
            df = conform(df, stored) if stored is not None else df      # keys are hashed under their stored types
            cols = [c for c in df.columns if c != BUCKET]
            overwrite_table(df.observe(obs, F.collect_set(bucket_expr(keys or [], buckets, cols, layout))
                                       .alias("b")), raw)
            touched = sorted(obs.get.get("b") or [])
        return merge_into(spark, df, master, keys or [], as_of, buckets=buckets, batch_rows=batch_rows,
                          batch_bytes=batch_bytes, dedupe_by=dedupe_by or None, layout=layout,
                          touched=touched, counts=counts, done=done)
    if mode == "overwrite":
        overwrite_table(df, master)
    elif mode == "append" and done is not None:
        batch_rows = df.count() if batch_rows is None else batch_rows
        append_once(df, master, done, batch_rows, as_of)
    elif mode == "append":
        append_table(df, master)
    else:
        raise ValueError(f"Unsupported write mode '{mode}'")
    n = batch_rows
    return {"records_inserted": n, "records_updated": 0 if n is not None else None, "records_merged": n}
