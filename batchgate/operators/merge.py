"""Versioned upsert of a batch into a current-state table.

Semantics (for rows whose key columns are all non-NULL):

* key in target and batch  -> every batch column except ``updated_at`` and
  ``record_version`` comes from the batch, ``updated_at`` = merge time,
  ``record_version`` = target + batch version;
* key only in the batch    -> inserted as the batch has it;
* key only in the target   -> kept unchanged.

A NULL in any key column never matches, so such batch rows are inserted on
every run and such target rows are kept. Several batch rows matching one
target row is an error (as for SQL MERGE).

Plan shapes:

* ``shuffle``: a left outer join of the target with the batch (updates and kept
  rows; adaptive execution can split a hot target key) and a left anti join
  of the batch with the target's keys (inserts; a hot batch key can be
  split). The right side of the anti join could not be split, so it is reduced first:
  target keys that a Bloom filter of the batch's keys lets through, one row a
  key. Whole target rows thus cross a shuffle once, and no side that cannot be split
  holds a key twice. NULL-key rows are split off first (they would all hash to one task).
* ``broadcast``: for a batch whose row count was checked to be small, the
  target is streamed through a broadcast left-outer join (never shuffled);
  inserts are the batch minus the batch-sized set of matched keys.

Keys that occur many times in the batch can be routed straight to the insert
branch (``insert_only_keys``), once a duplicate check has proved they have no
target row, so no join task receives a hot key.

Fence (``done``): target rows that this very load has already written, when a run
that wrote and then died is run again. They stay as they are (counted as the
insert or update that they were), their keys take no further part, and NULL-key
rows of the first attempt are replaced by those of the second. A bucket is
replaced as a whole, so this holds whichever buckets the first attempt reached.

Persistence (:func:`merge_into`) without a row-level-DML table format:
the target is partitioned by ``_bucket = pmod(hash(keys), N)``; only the
buckets present in the batch are read (partition pruning) and rewritten
(dynamic partition overwrite). A catalog table also declares Spark buckets
on the keys with the same hash (``bucketed`` layout), so the join reads the
target already hash-partitioned: only the batch is shuffled and each join
task writes one bucket. A bucket that has outgrown ``split_rows`` rows (a hot inserted key, say) is
recorded in the table's properties, and merges read its files like those of any
table, in splits, and join it by a shuffle that adaptive execution can split; its rows are
written by several tasks, each with a file of that bucket. This is not atomic
across buckets the way a table-format commit is.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import bloom
from ..functions.columns import as_of_column
from ..functions.predicates import any_null, null_safe
from ..session import TableRef, path_missing, scratch_path
from ..sources.files import row_width
from .key_counts import KeyCounts

BUCKET = "_bucket"
_WIDER = {"byte": 1, "short": 2, "integer": 3, "long": 4}
ACTION = "_action"
INSERT, UPDATE, KEEP = "insert", "update", "keep"
_M, _R = "_bg_m", "_bg_r"


class MergeConflictError(ValueError):
    """Several batch rows match the same target row."""


def _q(alias: str, c: str) -> Column:
    return F.col(f"`{alias}`.`{c}`")


def _key_cond(keys: list[str]) -> Column:
    # Qualified by alias, not by DataFrame: target and batch are often built
    # from the same source, and Dataset-bound references would be ambiguous.
    return reduce(lambda a, b: a & b, [_q("m", k) == _q("r", k) for k in keys])


def _project(target_cols: list[str], batch_cols: set[str], both: Column, r_only: Column,
             now: Column) -> list[Column]:
    out = []
    for c in target_cols:
        mc = _q("m", c)
        rc = _q("r", c) if c in batch_cols else None
        if c == S.RECORD_VERSION and rc is not None:
            col = F.when(both, mc + rc).when(r_only, rc).otherwise(mc)
        elif c == S.UPDATED_AT and rc is not None:
            col = F.when(both, now).when(r_only, rc).otherwise(mc)
        elif rc is not None:
            col = F.when(both | r_only, rc).otherwise(mc)
        else:
            col = mc
        out.append(col.alias(c))
    return out


def _action(both: Column, r_only: Column) -> Column:
    return F.when(both, F.lit(UPDATE)).when(r_only, F.lit(INSERT)).otherwise(F.lit(KEEP)).alias(ACTION)


def _align(df: DataFrame, target_cols: list[str], action: str) -> DataFrame:
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).alias(c) for c in target_cols],
                     F.lit(action).alias(ACTION))


def _widens(have: T.DataType, want: T.DataType) -> bool:
    """A cast that keeps every value: equal types, wider integers, float to double, NULL columns."""
    a, b = have.typeName(), want.typeName()
    if have == want or a in ("void", "null"):
        return True
    if isinstance(have, T.DecimalType) and isinstance(want, T.DecimalType):
        return want.scale >= have.scale and want.precision - want.scale >= have.precision - have.scale
    if isinstance(have, T.StructType) or isinstance(have, T.ArrayType) or isinstance(have, T.MapType):
        return have.simpleString() == want.simpleString()         # nullability aside
    return (a in _WIDER and b in _WIDER and _WIDER[a] < _WIDER[b]) or (a, b) == ("float", "double")


def conform(batch: DataFrame, target: T.StructType) -> DataFrame:
    """The batch under the target's column types, in its own column order.

    A column the target lacks, and a type whose values might not survive, are
    refused: a merge must not lose data without an error, and keys of another
    type would be hashed to other buckets than the stored ones.
    """
    types = {f.name: f.dataType for f in target.fields}
    extra = [c for c in batch.columns if c not in types and c != BUCKET]
    if extra:
        raise ValueError(f"Batch columns {extra} are not in the target; add them to the table first or drop them")
    changed = [f"{f.name}: {f.dataType.simpleString()} -> {types[f.name].simpleString()}" for f in batch.schema.fields
               if f.name in types and not _widens(f.dataType, types[f.name])]
    if changed:
        raise ValueError(f"Batch columns would not keep their values in the target's types: {changed}; cast them explicitly")
    return batch.select(*[F.col(f"`{f.name}`").cast(types[f.name]).alias(f.name)
                          if f.name in types and f.dataType != types[f.name] else F.col(f"`{f.name}`")
                          for f in batch.schema.fields])


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a frame in one pass: rows x fixed widths + actual text bytes."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema.fields
             if f.dataType.typeName() in ("string", "binary")]
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 (F.sum(sum(texts[1:], texts[0])) if texts else F.lit(0)).alias("b")).collect()[0]
    rows = int(row["n"] or 0)
    return rows, rows * row_width(df.schema) + int(row["b"] or 0)


def choose_strategy(batch: DataFrame, batch_bytes: int | None = None,
                    max_broadcast_bytes: int = 64 << 20) -> str:
    """``broadcast`` only for a batch whose measured size is within the limit."""
    if batch_bytes is None:
        batch_bytes = measure(batch)[1]
    return "broadcast" if batch_bytes <= max_broadcast_bytes else "shuffle"


def merge_frames(target: DataFrame, batch: DataFrame, keys: list[str] | str,
                 as_of: dt.datetime | str | None = None, *, strategy: str = "shuffle",
                 insert_only_keys: DataFrame | None = None, with_action: bool = False,
                 batch_bytes: int | None = None, max_broadcast_bytes: int = 64 << 20,
                 add_columns: bool = False, batch_rows: int | None = None, colocated: bool = False,
                 done: Column | None = None) -> DataFrame:
    """The merged table as a DataFrame (target's column order).

    Batch columns that the target lacks are refused; with ``add_columns`` they
    are added after the target's (NULL in kept rows).

    ``strategy``: ``shuffle``, or ``broadcast`` / ``auto`` which broadcast the
    batch only when its size (``batch_bytes`` if known, else measured by one
    aggregate over the batch) is at most ``max_broadcast_bytes``, and fall
    back to the shuffle plan otherwise. ``insert_only_keys``: keys known to
    have no target row (checked by the caller); their batch rows skip the
    join. ``with_action`` adds ``_action`` in {insert, update, keep}.
    ``batch_rows`` sizes the Bloom filter; ``colocated`` says that the target is
    read hash-partitioned by its keys (its reduced keys then need no exchange);
    ``done`` is the fence described above, a condition on target rows.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if strategy not in ("shuffle", "broadcast", "auto"):
        raise ValueError(f"Unknown merge strategy {strategy!r}")
    if strategy != "shuffle":
        strategy = choose_strategy(batch, batch_bytes, max_broadcast_bytes)
    extra = [c for c in batch.columns if c not in target.columns and c != BUCKET]
    if extra and not add_columns:
        raise ValueError(f"Batch columns {extra} are not in the target (add_columns=True adds them)")
    target = target.withColumns({c: F.lit(None).cast(batch.schema[c].dataType) for c in extra}) if extra else target
    target_cols = [c for c in target.columns if c not in (_M, _R)]
    missing = [c for c in target_cols if c not in batch.columns and c != BUCKET]
    if missing:
        raise ValueError(f"Batch lacks target columns {missing}; insert needs all of them")
    batch_cols = set(batch.columns)
    now = as_of_column(as_of)

    target_null = target.filter(any_null(keys))
    target_keyed = open_rows = target.filter(~any_null(keys))
    finished = []
    if done is not None:
        done = null_safe(done)
        target_null = target_null.filter(~done)          # inserted by the first attempt; its batch rows come again
        open_rows = target_keyed.filter(~done)
        was = F.when(F.col(S.UPDATED_AT).isNull(), INSERT).otherwise(UPDATE)
        finished = [target_keyed.filter(done).select(*target_cols, was.alias(ACTION))]
    batch_null = batch.filter(any_null(keys))
    batch_keyed = batch.filter(~any_null(keys))
    inserts = [_align(batch_null, target_cols, INSERT)]
    if insert_only_keys is not None:
        hot = F.broadcast(insert_only_keys.select(*keys).distinct())
        inserts.append(_align(batch_keyed.join(hot, keys, "left_semi"), target_cols, INSERT))
        batch_keyed = batch_keyed.join(hot, keys, "left_anti")

    m = open_rows.withColumn(_M, F.lit(True)).alias("m")
    r = batch_keyed.withColumn(_R, F.lit(True)).alias("r")
    small = strategy == "broadcast"
    joined = m.join(F.broadcast(r) if small else r, _key_cond(keys), "left_outer")
    both = _q("r", _R).isNotNull()
    main = joined.select(*_project(target_cols, batch_cols, both, F.lit(False), now), _action(both, F.lit(False)))
    inserts.append(_align(_unmatched(target_keyed, batch_keyed, keys, small, batch_rows, colocated), target_cols, INSERT))
    parts = [main, _align(target_null, target_cols, KEEP)] + finished + inserts
    out = reduce(DataFrame.unionByName, parts)
    return out if with_action else out.drop(ACTION)


def reduced_keys(target: DataFrame, batch: DataFrame, keys: list[str], batch_rows: int | None = None,
                 colocated: bool = False) -> DataFrame:
    """The target's keys that the batch may hold, one row a key.

    The Bloom filter of the batch's keys drops the others before anything is
    shuffled; duplicates are combined map-side, so a key on a third of the
    target leaves a task once. Rebalanced, so that a join on it does not reuse
    the aggregate's partitioning, under which no side could be split. Keys of a
    ``colocated`` target are never shuffled, so there is nothing to filter for.
    """
    found = target.select(*keys)
    if colocated:
        return found.distinct()
    if bloom.same_hash(target.schema, batch.schema, keys):
        bits = bloom.log2_bits(batch_rows)
        found = found.where(bloom.might_contain(bloom.build(batch.select(*keys), keys, bits).scalar(), keys, bits))
    return found.distinct().hint("rebalance")


def _unmatched(target: DataFrame, batch: DataFrame, keys: list[str], small: bool, batch_rows: int | None = None,
               colocated: bool = False) -> DataFrame:
    """Batch rows without a target row. A small batch meets the target's keys by
    broadcast: the keys it matches are no more than its own."""
    if small:
        found = target.select(*keys).join(F.broadcast(batch.select(*keys)), keys, "left_semi")
    else:
        found = reduced_keys(target, batch, keys, batch_rows, colocated)
    return batch.join(found, keys, "left_anti")


def matched_rows(target: DataFrame, batch: DataFrame, keys: list[str] | str,
                 as_of: dt.datetime | str | None = None) -> DataFrame:
    """The rows a merge updates, as they are afterwards: the inner branch alone."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    m, r = (df.filter(~any_null(keys)).alias(a) for df, a in ((target, "m"), (batch, "r")))
    joined = m.join(r, _key_cond(keys), "inner")
    return joined.select(*_project(target.columns, set(batch.columns), F.lit(True), F.lit(False), as_of_column(as_of)))


def inserted_rows(target: DataFrame, batch: DataFrame, keys: list[str] | str) -> DataFrame:
    """The rows a merge inserts: the anti branch alone (NULL keys never match)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    new = _unmatched(target.filter(~any_null(keys)), batch.filter(~any_null(keys)), keys, False)
    return new.unionByName(batch.filter(any_null(keys))).select(*target.columns)


def merge_metrics(merged_with_action: DataFrame) -> DataFrame:
    """One row: inserted, updated, merged (= inserted + updated), kept, total."""
    a = F.col(ACTION)
    return merged_with_action.agg(
        F.count_if(a == INSERT).alias("records_inserted"),
        F.count_if(a == UPDATE).alias("records_updated"),
        F.count_if(a != KEEP).alias("records_merged"),
        F.count_if(a == KEEP).alias("records_kept"),
        F.count(F.lit(1)).alias("records_total"),
    )


def key_counts(batch: DataFrame, keys: list[str]) -> DataFrame:
    """Per non-NULL key, its number of batch rows (partial aggregation, skew-safe)."""
    return (batch.filter(~any_null(keys)).groupBy(*keys)
                 .agg(F.count(F.lit(1)).alias("_bg_n")))


def dedupe_latest(batch: DataFrame, keys: list[str], order_by: list[str] | str) -> DataFrame:
    """One row per non-NULL key: the row with the greatest ``order_by`` values.

    Ties are broken by the remaining columns, so the pick is deterministic.
    ``max_by`` is a partial aggregate: a key with a third of the batch is
    reduced map-side. NULL-key rows never match and are all kept.
    """
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    cols = batch.columns
    rank = F.struct(*[F.col(c) for c in order_by + [c for c in cols if c not in order_by]])
    keyed = (batch.filter(~any_null(keys)).groupBy(*keys)
                  .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), rank).alias("_bg_row"))
                  .select("_bg_row.*"))
    return keyed.unionByName(batch.filter(any_null(keys)))


def check_duplicate_matches(target: DataFrame, batch: DataFrame, keys: list[str],
                            counts: DataFrame | None = None) -> None:
    """Raise when a key repeated in the batch also has a target row."""
    counts = key_counts(batch, keys) if counts is None else counts
    dups = counts.filter(F.col("_bg_n") > 1).select(*keys)
    conflict = dups.join(reduced_keys(target, dups, keys), keys, "left_semi").limit(1).collect()
    if conflict:
        raise MergeConflictError(
            f"Several batch rows match one target row for key {conflict[0].asDict()}")


def heavy_keys(counts: DataFrame, batch_rows: int, max_keys: int = 10000,
               min_rows: int = 10000) -> DataFrame:
    """Keys with more than T batch rows, T = max(min_rows, batch_rows / max_keys).

    At most ``batch_rows / T <= max_keys`` keys can pass, so the result has a
    proven size bound and may be broadcast.
    """
    return counts.filter(F.col("_bg_n") > hot_threshold(batch_rows, max_keys, min_rows)).drop("_bg_n")


def hot_threshold(batch_rows: int, max_keys: int = 10000, min_rows: int = 10000) -> int:
    return max(min_rows, -(-batch_rows // max_keys))


LAYOUTS = ("folders", "bucketed")
_PROP_LAYOUT, _PROP_BUCKETS, _PROP_KEYS = "batchgate.layout", "batchgate.buckets", "batchgate.keys"
_PROP_SPLIT = "batchgate.split_buckets"           # buckets too large for one task
_PROP_DYNAMIC = "batchgate.dynamic_overwrite"     # the table's own options hold the overwrite mode
_MARKER = "_batchgate_layout"     # path tables: a folder Spark's listing skips (leading '_')
_MARKER_SCHEMA = f"`{_PROP_LAYOUT}` string, `{_PROP_BUCKETS}` string, `{_PROP_KEYS}` string"


def _key_signature(schema: T.StructType, keys: list[str]) -> str:
    """Key columns and their types, in the order in which they are hashed."""
    return ",".join(f"{k}:{schema[k].dataType.simpleString()}" for k in keys)


def target_schema(spark: SparkSession, ref: TableRef) -> T.StructType | None:
    """Columns of a stored merge target without the bucket; None if it does not exist yet."""
    if not ref.exists(spark):
        return None
    return T.StructType([f for f in ref.read(spark).schema.fields if f.name != BUCKET])


def bucket_expr(keys: list[str], buckets: int, all_columns: list[str], layout: str = "folders") -> Column:
    """Bucket of a row: hash of its key; NULL-key rows spread by their columns.
    The keys must have the stored key types (:func:`conform`).

    ``bucketed`` uses Spark's own bucket hash (Murmur3 ``hash``), so a row's
    folder equals the bucket file Spark's ``bucketBy`` puts it in. The spread
    of NULL-key rows leaves out the batch metadata columns: ``ingested_at``
    may be the query's current time, which differs between the pass that
    lists the touched buckets and the write, and a row landing in an unread
    bucket would make the dynamic overwrite drop that bucket's rows.
    """
    h = F.hash if layout == "bucketed" else F.xxhash64
    stable = [c for c in all_columns if c not in S.METADATA_COLUMNS] or list(keys)
    by_key = F.pmod(h(*[F.col(k) for k in keys]), F.lit(buckets))
    by_row = F.pmod(h(*[F.col(c) for c in stable]), F.lit(buckets))
    return F.when(any_null(keys), by_row).otherwise(by_key).cast("int")


def _clustered(df: DataFrame) -> DataFrame:
    """Cluster rows by bucket before a partitioned write.

    Without it every task writes one file into every bucket it holds (tasks x
    buckets small files). REBALANCE lets AQE size the write tasks: small
    buckets are coalesced, a bucket larger than the advisory size is split
    over several tasks, so no single task gets a hot bucket.
    """
    return df.hint("rebalance", BUCKET)


def _properties(spark: SparkSession, ref: TableRef) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {ref.name}").collect()}


def _table_layout(spark: SparkSession, ref: TableRef, layout: str, buckets: int, keys: str) -> None:
    """Refuse a merge whose layout, bucket count or keys differ from the table's.

    The bucket of a key decides which folders are read; another hash, count,
    key list or key type would silently miss rows, so tables record them
    (catalog tables as properties, path tables in a marker folder).
    """
    if ref.name:
        props = _properties(spark, ref)
    else:
        try:
            props = (spark.read.schema(_MARKER_SCHEMA).json(f"{ref.path}/{_MARKER}")
                     .first().asDict())
        except AnalysisException as e:
            if not path_missing(e):
                raise
            return                                 # written before markers existed
    have = (props.get(_PROP_LAYOUT) or "folders", int(props.get(_PROP_BUCKETS) or buckets), props.get(_PROP_KEYS) or keys)
    if have != (layout, buckets, keys):
        raise ValueError(f"Table {ref.label} has layout={have[0]} buckets={have[1]} keys={have[2]}; "
                         f"merge asked for layout={layout} buckets={buckets} keys={keys}")


def _read_buckets(spark: SparkSession, ref: TableRef, touched: list[int],
                  buckets: int | None = None) -> DataFrame | None:
    """Rows of the touched buckets only; None when the table does not exist.

    A path table is read through a glob of the touched bucket folders with
    ``basePath``, so only those folders are listed (a full read would list
    every bucket before pruning). A catalog table prunes by its partitions.
    """
    if ref.name:
        if not spark.catalog.tableExists(ref.name):
            return None
        table = spark.table(ref.name)
        if BUCKET not in table.columns:
            return _adopt(table, ref)
        return table.filter(F.col(BUCKET).isin(touched))
    reader = spark.read.format(ref.format).option("basePath", ref.path)
    if touched and buckets is not None and 2 * len(touched) > buckets:
        reader = None          # most buckets touched: list the whole table once
    if touched and reader is not None:
        names = ",".join(str(b) for b in touched)
        glob = f"{ref.path}/{BUCKET}={{{names}}}" if len(touched) > 1 else f"{ref.path}/{BUCKET}={names}"
        try:
            return reader.load(glob)
        except AnalysisException as e:
            if not path_missing(e):                # else: none of these buckets exists yet
                raise
    if not ref.exists(spark):
        return None
    whole = spark.read.format(ref.format).load(ref.path)
    if BUCKET not in whole.columns:
        return _adopt(whole, ref)
    if reader is None:
        return whole.filter(F.col(BUCKET).isin(touched))
    return whole.filter(F.lit(False))


def _adopt(table: DataFrame, ref: TableRef) -> None:
    """A table without the bucket layout: an empty one (e.g. provisioned from
    the DDL) is replaced by the layout on first write; a filled one is refused,
    since merging into it by bucket would miss its rows."""
    if table.limit(1).count() == 0:
        return None
    raise ValueError(f"{ref.label} has rows but no {BUCKET} column; rewrite it once with "
                     f"merge_into into a new table (or add {BUCKET}) before merging batches")


def _counted(df: DataFrame, metrics: Observation) -> DataFrame:
    """Counts the actions on the frame that is written (below it, in a shuffle's
    map stage, a stage that runs again would count again)."""
    a = F.col(ACTION)
    return df.observe(metrics, F.count_if(a == INSERT).alias("records_inserted"),
                      F.count_if(a == UPDATE).alias("records_updated"), F.count(F.lit(1)).alias("rows")).drop(ACTION)


def _rows_written(metrics: Observation) -> int:
    return int(metrics.get.get("rows") or 0)


def _write_new(spark: SparkSession, df: DataFrame, ref: TableRef, keys: list[str], buckets: int,
               layout: str, metrics: Observation, absent: bool = False) -> None:
    signature = _key_signature(df.schema, keys)
    w = _counted(_clustered(df), metrics).write.format(ref.format).partitionBy(BUCKET).mode("overwrite")
    if layout == "bucketed":
        w = w.bucketBy(buckets, *keys).sortBy(*keys)
    if ref.name:
        # Kept as an option of the table: later inserts replace the buckets they write, whatever the session's mode.
        w.option("partitionOverwriteMode", "dynamic").saveAsTable(ref.name)
        spark.sql(f"ALTER TABLE {ref.name} SET TBLPROPERTIES "
                  f"('{_PROP_LAYOUT}' = '{layout}', '{_PROP_BUCKETS}' = '{buckets}', '{_PROP_KEYS}' = '{signature}', "
                  f"'{_PROP_DYNAMIC}' = 'true')")
    else:
        # Nothing there yet: buckets are put in place as whole folders, as by later merges.
        (w.option("partitionOverwriteMode", "dynamic") if absent else w).save(ref.path)
        marker = spark.createDataFrame([(layout, str(buckets), signature)], _MARKER_SCHEMA)
        marker.coalesce(1).write.mode("overwrite").json(f"{ref.path}/{_MARKER}")


def _overwrite_buckets(spark: SparkSession, df: DataFrame, ref: TableRef, layout: str, metrics: Observation) -> None:
    if ref.name:
        if layout == "folders":
            df = _clustered(df)
        cols = spark.table(ref.name).columns
        out = _counted(df, metrics).select(*cols).write
        if _properties(spark, ref).get(_PROP_DYNAMIC) == "true":
            out.insertInto(ref.name, overwrite=True)
            return
        # A table of an earlier version has no overwrite mode of its own, and an insert then takes the
        # session's: set for this statement and restored.
        key = "spark.sql.sources.partitionOverwriteMode"
        previous = spark.conf.get(key)
        spark.conf.set(key, "dynamic")
        try:
            out.insertInto(ref.name, overwrite=True)
        finally:
            spark.conf.set(key, previous)
    else:
        (_counted(_clustered(df), metrics).write.format(ref.format).partitionBy(BUCKET).mode("overwrite")
           .option("partitionOverwriteMode", "dynamic").save(ref.path))


def resolve_layout(ref: TableRef, layout: str | None) -> str:
    return layout or ("bucketed" if ref.name else "folders")


def own_rows(batch_id: int, business_date: str, source_name: str | None) -> Column:
    """Target rows that a load (batch id, business date, source) has written."""
    return ((F.col(S.BATCH_ID) == F.lit(batch_id)) & (F.col(S.BUSINESS_DATE) == F.lit(business_date).cast("timestamp"))
            & F.col(S.SOURCE_NAME).eqNullSafe(F.lit(source_name)))


def split_buckets(spark: SparkSession, ref: TableRef) -> list[int]:
    """Buckets of a catalog table that were recorded as too large for one task."""
    return [int(b) for b in (_properties(spark, ref).get(_PROP_SPLIT) or "").split(",") if b]


def _record_large_buckets(spark: SparkSession, ref: TableRef, touched: list[int], rows_written: int, split_rows: int) -> None:
    """Measures the buckets just written and records those above ``split_rows`` rows (a bucket may shrink again).
    No bucket can be above it when fewer rows were written at all: the usual case, without a job."""
    before = set(split_buckets(spark, ref))
    large = before - set(touched)
    if rows_written > split_rows:
        # Row counts come from the files' footers: no column is read. At most one row a bucket.
        sizes = spark.table(ref.name).where(F.col(BUCKET).isin(touched)).groupBy(BUCKET).count()
        large |= {r[BUCKET] for r in sizes.where(F.col("count") > split_rows).collect()}
    if large != before:
        spark.sql(f"ALTER TABLE {ref.name} SET TBLPROPERTIES ('{_PROP_SPLIT}' = '{','.join(map(str, sorted(large)))}')")


def _split_scan(spark: SparkSession, ref: TableRef, buckets: list[int]) -> DataFrame | None:
    """The files of these buckets read in splits, without the bucket layout that would give each bucket to one task."""
    table = spark.table(ref.name)
    root = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {ref.name}").collect()}["Location"]
    try:
        return (spark.read.format(ref.format).schema(table.schema).option("basePath", root)
                .load([f"{root}/{BUCKET}={b}" for b in buckets]).select(*table.columns))
    except AnalysisException as e:
        if not path_missing(e):
            raise
        return None


def _landed(staged: DataFrame) -> tuple[DataFrame, int, int, list[int]]:
    """A deduplicated batch written once: the frame read back, its rows, bytes and buckets, observed on that write."""
    spark, obs = staged.sparkSession, Observation("batchgate_staged")
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in staged.schema.fields
             if f.dataType.typeName() in ("string", "binary")]
    path = scratch_path(spark, "staged")
    (staged.observe(obs, F.count(F.lit(1)).alias("n"), (F.sum(sum(texts[1:], texts[0])) if texts else F.lit(0)).alias("b"),
                    F.collect_set(BUCKET).alias("buckets")).write.parquet(path))
    rows, text_bytes = int(obs.get["n"] or 0), int(obs.get["b"] or 0)
    return spark.read.schema(staged.schema).parquet(path), rows, rows * row_width(staged.schema) + text_bytes, sorted(obs.get["buckets"] or [])


def merge_into(spark: SparkSession, batch: DataFrame, target: TableRef | dict | str,
               keys: list[str] | str, as_of: dt.datetime | str | None = None, *,
               buckets: int = 64, batch_rows: int | None = None, batch_bytes: int | None = None,
               max_broadcast_bytes: int = 64 << 20, check_duplicates: bool = True,
               hot_key_rows: int = 10000, dedupe_by: list[str] | str | None = None,
               layout: str | None = None, touched: list[int] | None = None,
               counts: KeyCounts | None = None, done: Column | None = None,
               split_rows: int = 20_000_000) -> dict:
    """Merge ``batch`` into a stored table; returns the merge counters.

    Table formats with row-level DML use their MERGE. Otherwise the bucketed
    layout described in the module docstring is used (created on first use).
    The broadcast plan is used only when the batch is proven small:
    ``batch_bytes`` (measured while landing) or, if not given, measured by
    one aggregate, at most ``max_broadcast_bytes``. Otherwise the shuffle plan.
    ``counts``: key counts of this very batch, if a rule has taken them.
    ``done``: the condition on target rows that this load has already written
    (:func:`own_rows`), for a run that may be a repeat of one that died.
    ``split_rows``: rows above which a bucket of the ``bucketed`` layout is no
    longer read and joined by one task.
    """
    ref = TableRef.of(target)
    keys = [keys] if isinstance(keys, str) else list(keys)
    if dedupe_by:
        batch = dedupe_latest(batch, keys, dedupe_by)
    if ref.supports_row_level_dml():
        if ref.exists(spark):
            return _merge_with_table_format(batch, ref, keys, as_of)
        return _create_with_table_format(batch, ref)

    layout = resolve_layout(ref, layout)
    if layout not in LAYOUTS or (layout == "bucketed" and not ref.name):
        raise ValueError(f"layout must be one of {LAYOUTS} ('bucketed' needs a catalog table)")
    stored = target_schema(spark, ref)
    if stored is not None:
        batch = conform(batch, stored)
    bcols = [c for c in batch.columns if c != BUCKET]
    staged = batch.select(*bcols).withColumn(BUCKET, bucket_expr(keys, buckets, bcols, layout))
    metrics = Observation("batchgate_merge")
    if dedupe_by:
        # The one aggregate of the run; no key repeats in what it leaves.
        staged, batch_rows, batch_bytes, touched = _landed(staged)
    elif touched is None:
        touched = sorted(r[0] for r in staged.select(BUCKET).distinct().collect())  # <= buckets values
    current = _read_buckets(spark, ref, touched, buckets)
    if current is None:
        _write_new(spark, staged.withColumn(ACTION, F.lit(INSERT)), ref, keys, buckets, layout, metrics, absent=stored is None)
        if layout == "bucketed":
            _record_large_buckets(spark, ref, touched, _rows_written(metrics), split_rows)
        return _counters(metrics)
    _table_layout(spark, ref, layout, buckets, _key_signature(staged.schema, keys))

    if batch_rows is None or batch_bytes is None:
        batch_rows, batch_bytes = measure(staged)
    hot = None
    if check_duplicates and not dedupe_by:
        hot = _checked_hot_keys(current, counts or KeyCounts(staged), keys, batch_rows, hot_key_rows, done)
    args = dict(strategy="auto", insert_only_keys=hot, with_action=True, batch_bytes=batch_bytes, batch_rows=batch_rows,
                max_broadcast_bytes=max_broadcast_bytes, done=done)
    large = sorted(set(split_buckets(spark, ref)) & set(touched)) if layout == "bucketed" else []
    apart = _split_scan(spark, ref, large) if large else None
    if apart is None:
        merged = merge_frames(current, staged, keys, as_of, colocated=layout == "bucketed", **args)
    else:
        in_large = F.col(BUCKET).isin(large)
        merged = (merge_frames(current.where(~in_large), staged.where(~in_large), keys, as_of, colocated=True, **args)
                  .unionByName(_clustered(merge_frames(apart, staged.where(in_large), keys, as_of, **args))))
    _overwrite_buckets(spark, merged, ref, layout, metrics)
    if layout == "bucketed":
        _record_large_buckets(spark, ref, touched, _rows_written(metrics), split_rows)
    return _counters(metrics)


def _checked_hot_keys(current: DataFrame, counts: KeyCounts, keys: list[str], batch_rows: int, hot_key_rows: int,
                      done: Column | None) -> DataFrame | None:
    """Refuses repeated keys that have a target row; the hot ones among the others, if any.

    When no batch key repeats (the usual case) neither the conflict join nor the hot-key route is needed.
    """
    found = counts.of(keys)
    if found.top <= 1:
        return None
    repeated = found.repeated.select(*[F.col(k).cast(current.schema[k].dataType).alias(k) for k in keys], "_bg_n")
    if done is not None:
        # Keys whose rows stand there from the first attempt are no conflict, and are not inserted again.
        own, current = current.filter(null_safe(done)), current.filter(~null_safe(done))
        repeated = repeated.join(reduced_keys(own, repeated, keys), keys, "left_anti")
    check_duplicate_matches(current, repeated, keys, repeated)
    if found.top > hot_threshold(batch_rows, min_rows=hot_key_rows):
        return heavy_keys(repeated, batch_rows, min_rows=hot_key_rows)
    return None


def _counters(obs: Observation) -> dict:
    got = obs.get
    ins, upd = int(got.get("records_inserted") or 0), int(got.get("records_updated") or 0)
    return {"records_inserted": ins, "records_updated": upd, "records_merged": ins + upd}


def _create_with_table_format(batch: DataFrame, ref: TableRef) -> dict:
    """First load of a Delta / Iceberg table: a plain write (no bucket folders,
    which those formats do not take); later loads MERGE into it. Untested
    here, as no such jar is available."""
    metrics = Observation("batchgate_merge")
    _counted(batch.withColumn(ACTION, F.lit(INSERT)), metrics).write.format(ref.format).saveAsTable(ref.name)
    return _counters(metrics)


def _merge_with_table_format(batch: DataFrame, ref: TableRef, keys: list[str],
                             as_of: dt.datetime | str | None) -> dict:
    """MERGE through the table format (Delta/Iceberg): the provider path."""
    t = ref.name
    cond = F.expr(" AND ".join(f"{t}.`{k}` = r.`{k}`" for k in keys))
    assignments = {f"`{c}`": F.col(f"r.`{c}`") for c in batch.columns
                   if c not in (S.UPDATED_AT, S.RECORD_VERSION)}
    assignments[S.UPDATED_AT] = as_of_column(as_of)
    assignments[S.RECORD_VERSION] = F.expr(f"{t}.{S.RECORD_VERSION} + r.{S.RECORD_VERSION}")
    (batch.alias("r").mergeInto(t, cond)
          .whenMatched().update(assignments).whenNotMatched().insertAll().merge())
    return {"records_inserted": None, "records_updated": None, "records_merged": None}
