"""Projections: batch metadata, column drops, the typed 'prepared' projection."""

from __future__ import annotations

import datetime as dt
from typing import Iterable, NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S


def as_of_column(as_of: dt.datetime | str | None) -> Column:
    """A fixed timestamp for repeatable runs, else the query's current time."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(str(as_of)).cast("timestamp")


def with_metadata(df: DataFrame, batch_id: int, business_date: str, source_name: str,
                  as_of: dt.datetime | str | None = None) -> DataFrame:
    """Append the six batch metadata columns in one projection.

    ``record_version`` starts at 1, ``ingested_at`` is the run time and
    ``updated_at`` stays NULL until a merge updates the row.
    """
    return df.withColumns({
        S.BATCH_ID: F.lit(batch_id).cast("bigint"),
        S.BUSINESS_DATE: F.lit(business_date).cast("timestamp"),
        S.SOURCE_NAME: F.lit(source_name).cast("string"),
        S.RECORD_VERSION: F.lit(1).cast("bigint"),
        S.INGESTED_AT: as_of_column(as_of),
        S.UPDATED_AT: F.lit(None).cast("timestamp"),
    })


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop by name; names that are absent are ignored."""
    return df.drop(*list(names))


def drop_metadata(df: DataFrame) -> DataFrame:
    return df.drop(*S.METADATA_COLUMNS)


def parse_timestamp(c: str | Column, fmt: str) -> Column:
    """Text -> TIMESTAMP by pattern; a value that does not parse gives NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(col, F.lit(fmt))


def prepared_projection(df: DataFrame, columns: list[str], casts: dict[str, str] | None = None,
                        not_null: Iterable[str] = ()) -> DataFrame:
    """Select ``columns`` in order, ``try_cast`` some, and enforce NOT NULL keys.

    File tables record NOT NULL but do not enforce it, so the check lives in
    the kept column itself: ``coalesce(key, raise_error(..))`` fails the query
    on the first NULL key and cannot be pruned away.
    """
    casts = casts or {}
    required = set(not_null)
    out = []
    for name in columns:
        col = F.col(name)
        if name in casts:
            col = col.try_cast(casts[name])
        if name in required:
            col = F.coalesce(col, F.raise_error(F.lit(f"NOT NULL constraint violated: {name}")))
        out.append(col.alias(name))
    return df.select(*out)


class Projected(NamedTuple):
    """``rows``: the projected rows; ``rejects``: one row per value that did not cast (row key, column, value,
    wanted type); ``counts``: how many values each cast column lost."""
    rows: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


REJECTS = "_bg_rejects"


def projection_with_rejects(df: DataFrame, columns: list[str], casts: dict[str, str], path: str,
                            keys: Iterable[str] = (), not_null: Iterable[str] = ()) -> Projected:
    """:func:`prepared_projection` that tells what it could not cast.

    One pass: rows are written to ``path`` with their rejects beside them, the
    counts are observed on that write, and both frames read the copy. A value is rejected when it
    is not NULL and its ``try_cast`` is. ``keys`` name the row in the rejects (joined by '|', NULL as '').
    """
    odd = {c: F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in casts.items() if c in columns}
    entries = [F.when(bad, F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"),
                                    F.lit(casts[c]).alias("wanted_type"))) for c, bad in odd.items()]
    none = F.array().cast("array<struct<column_name:string,value:string,wanted_type:string>>")
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    tagged = df.withColumns({REJECTS: F.filter(F.array(*entries), lambda x: x.isNotNull()) if entries else none, "_bg_key": key})
    out = prepared_projection(tagged, [*columns, REJECTS, "_bg_key"], casts, not_null)
    obs = Observation("batchgate_projection")
    terms = [F.count_if(F.array_contains(F.col(f"{REJECTS}.column_name"), c)).alias(f"n{i}") for i, c in enumerate(odd)]
    out.observe(obs, F.count(F.lit(1)).alias("rows"), *terms).write.parquet(path)
    landed = df.sparkSession.read.schema(out.schema).parquet(path)
    rejects = landed.where(F.size(REJECTS) > 0).select(F.col("_bg_key").alias("record_key"), F.inline(REJECTS))
    return Projected(landed.drop(REJECTS, "_bg_key"), rejects, {c: int(obs.get[f"n{i}"] or 0) for i, c in enumerate(odd)})


def project_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto a declared schema: by name, ``try_cast`` to each type, NULL
    for columns the frame lacks, NOT NULL fields enforced in the plan."""
    present = set(df.columns)
    out = []
    for f in schema.fields:
        col = F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)
        if not f.nullable:
            col = F.coalesce(col, F.raise_error(F.lit(f"NOT NULL constraint violated: {f.name}")))
        out.append(col.alias(f.name))
    return df.select(*out)
