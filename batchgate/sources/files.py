"""File sources: dated CSV drops under an explicit schema, backfills, landing.

A batch is parsed from text exactly once: :func:`land` writes it to columnar
storage in the shared scratch folder, and every later pass (validation,
audit, metadata, merge) reads the landed copy with column pruning.
"""

from __future__ import annotations

import csv
import datetime as dt
import re
from dataclasses import dataclass
from functools import reduce
from typing import Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import SourceSpec, parse_business_date

# Placeholders of a dated file pattern and their glob classes.
DATE_TOKENS = {"{dd}": ("%d", "[0-3][0-9]"), "{MM}": ("%m", "[0-1][0-9]"),
               "{yyyy}": ("%Y", "[0-9][0-9][0-9][0-9]")}
CORRUPT = "_corrupt_record"


def dated_path(source: SourceSpec | dict, business_date: str) -> str:
    """Base path + file pattern with ``{dd} {MM} {yyyy}`` from a yyyy-MM-dd date."""
    src = source if isinstance(source, SourceSpec) else SourceSpec.of(source)
    day = parse_business_date(business_date)
    name = src.file_format
    for token, (fmt, _) in DATE_TOKENS.items():
        name = name.replace(token, day.strftime(fmt))
    return f"{src.path.rstrip('/')}/{name}"


def _reader(spark: SparkSession, src: SourceSpec, schema: T.StructType | None, check_header: bool,
            corrupt: bool):
    r = (spark.read.format(src.format)
         .option("header", src.header)
         .option("delimiter", src.delimiter)
         .option("mode", "PERMISSIVE"))
    if src.timestamp_format:
        r = r.option("timestampFormat", src.timestamp_format).option("timestampNTZFormat", src.timestamp_format)
    if src.date_format:
        r = r.option("dateFormat", src.date_format)
    if schema is not None:
        if corrupt:
            schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
            r = r.option("columnNameOfCorruptRecord", CORRUPT)
        r = r.schema(schema).option("enforceSchema", not (check_header and src.header))
    return r


def scan_csv(spark: SparkSession, paths: str | list[str], schema: T.StructType,
             source: SourceSpec | dict | None = None, *, corrupt: bool = False,
             path_column: str | None = None) -> DataFrame:
    """CSV under an explicit schema.

    ``binding='position'`` binds columns by position; with ``check_header``
    the header must name the schema's columns (in order, case ignored) or the
    read fails instead of silently shifting data. ``binding='name'`` maps the
    header names of **each file** to the schema (case ignored), parses
    timestamps by pattern, and yields NULL for unparseable values; missing,
    unknown or repeated names fail the read, but for the source's
    ``optional_columns`` (NULL where a file lacks them) and ``ignored_columns`` (read past). ``corrupt``
    adds ``_corrupt_record`` for rows that failed to parse (the raw line by
    position; the row's fields as text by name). ``path_column`` adds the
    file of each row.
    """
    src = source if isinstance(source, SourceSpec) else SourceSpec.of(source or {})
    if src.binding == "name":
        return _scan_by_name(spark, paths, schema, src, corrupt, path_column)
    df = _reader(spark, src, schema, src.check_header, corrupt).load(paths)
    return df.withColumn(path_column, F.col("_metadata.file_path")) if path_column else df


class HeaderMismatchError(ValueError):
    """A file's header does not name the schema's columns."""


@dataclass(frozen=True)
class HeaderMatch:
    """One distinct header beside the schema: where each column stands, and what does not fit."""
    names: tuple[str, ...]
    files: tuple[str, ...]
    positions: dict[str, int]            # schema column -> place in the header
    recased: tuple[str, ...]             # header names that fit but for their case
    missing: tuple[str, ...]             # schema columns the header lacks, optional ones left out
    unknown: tuple[str, ...]             # header names outside the schema, ignored ones left out
    repeated: tuple[str, ...]            # header names that occur more than once

    @property
    def fits(self) -> bool:
        return not (self.missing or self.unknown or self.repeated)


def match_header(names: Iterable[str], schema: T.StructType, source: SourceSpec | dict | None = None, *,
                 files: Iterable[str] = (), case_sensitive: bool = False) -> HeaderMatch:
    """Header names against schema columns; as for by-position headers, case is ignored unless the session's
    analyzer is case-sensitive."""
    src = source if isinstance(source, SourceSpec) else SourceSpec.of(source or {})
    fold = str if case_sensitive else str.lower
    names = tuple(names)
    places: dict[str, list[int]] = {}
    for i, name in enumerate(names):
        places.setdefault(fold(name), []).append(i)
    wanted = {fold(f.name): f.name for f in schema.fields}
    optional, ignored = ({fold(c) for c in more} for more in (src.optional_columns, src.ignored_columns))
    return HeaderMatch(
        names, tuple(files), {column: places[key][0] for key, column in wanted.items() if key in places},
        tuple(n for n in names if fold(n) in wanted and n != wanted[fold(n)]),
        tuple(column for key, column in wanted.items() if key not in places and key not in optional),
        tuple(n for n in names if fold(n) not in wanted and fold(n) not in ignored),
        tuple(names[at[0]] for key, at in places.items() if len(at) > 1 and (key in wanted or key not in ignored)))


_LEADING = 100          # blank lines before a header are skipped, as the CSV reader does; looked for among so many lines


def _header_lines(spark: SparkSession, paths) -> list[tuple[str, list[str]]]:
    """Each distinct header line with its files, found by one job over the first block of every file.

    A session of its own keeps every block in a partition of its own, so the
    first rows of a partition that starts at byte 0 are the first lines of a
    file: a filter on the row number, no sort or shuffle of the text. The
    driver receives one row a distinct header (with its paths, which the scans need).
    """
    probe = spark.newSession()
    probe.conf.set("spark.sql.files.openCostInBytes", probe.conf.get("spark.sql.files.maxPartitionBytes"))
    lines = probe.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("row"))
    top = lines.where((F.col("at") == 0) & (F.col("row") < _LEADING) & (F.trim("value") != ""))
    first = top.groupBy("path").agg(F.min_by("value", "row").alias("line"))
    found = first.groupBy("line").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("line").collect()
    return [(r["line"], [unquote(p) for p in r["paths"]]) for r in found]


def match_headers(spark: SparkSession, paths, schema: T.StructType, source: SourceSpec | dict | None = None) -> list[HeaderMatch]:
    """The distinct headers of the files under ``paths``, each matched with the schema."""
    src = source if isinstance(source, SourceSpec) else SourceSpec.of(source or {})
    if not src.header:
        raise ValueError("binding by name needs files with a header")
    sensitive = spark.conf.get("spark.sql.caseSensitive").lower() == "true"
    return [match_header(next(csv.reader([line], delimiter=src.delimiter, escapechar="\\", doublequote=False)), schema, src,
                         files=found, case_sensitive=sensitive)
            for line, found in _header_lines(spark, paths)]


def header_report(spark: SparkSession, paths, schema: T.StructType, source: SourceSpec | dict | None = None) -> DataFrame:
    """One row per distinct header of a drop: its names, how many files have it, and what does not fit the schema."""
    rows = [(list(m.names), len(m.files), list(m.recased), list(m.missing), list(m.unknown), list(m.repeated), m.fits)
            for m in match_headers(spark, paths, schema, source)]
    texts = ", ".join(f"{c} array<string>" for c in ("recased", "missing", "unknown", "repeated"))
    return spark.createDataFrame(rows, f"header array<string>, files bigint, {texts}, fits boolean")


def _scan_by_name(spark: SparkSession, paths, schema: T.StructType, src: SourceSpec, corrupt: bool,
                  path_column: str | None) -> DataFrame:
    """One scan for each distinct header among the files; headers that do not fit are refused together."""
    matches = match_headers(spark, paths, schema, src)
    wrong = [m for m in matches if not m.fits]
    if wrong:
        raise HeaderMismatchError("; ".join(
            f"header {list(m.names)} of {len(m.files)} file(s), e.g. {m.files[0]}: missing={list(m.missing)}, "
            f"unknown={list(m.unknown)}, repeated={list(m.repeated)}" for m in wrong)
            + " (optional_columns / ignored_columns of the source list exceptions)")
    if len(matches) == 1:
        return _bound_by_name(spark, paths, matches[0], schema, src, corrupt, path_column)
    parts = [_bound_by_name(spark, list(m.files), m, schema, src, corrupt, path_column) for m in matches]
    if not parts:                                       # files without a line
        extra = [T.StructField(c, T.StringType()) for c in ([CORRUPT] if corrupt else []) + ([path_column] if path_column else [])]
        return spark.createDataFrame([], T.StructType(schema.fields + extra))
    return reduce(DataFrame.unionByName, parts)


def _bound_by_name(spark: SparkSession, paths, match: HeaderMatch, schema: T.StructType, src: SourceSpec,
                   corrupt: bool, path_column: str | None) -> DataFrame:
    # Text columns named by place: header names may differ from others by their case only.
    place = [f"_h{i}" for i in range(len(match.names))]
    raw = _reader(spark, src, T.StructType([T.StructField(c, T.StringType()) for c in place]), False, corrupt).load(paths)
    out, bad = [], []
    for f in schema.fields:
        if f.name not in match.positions:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(place[match.positions[f.name]])
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) and src.timestamp_format:
            parsed = F.try_to_timestamp(c, F.lit(src.timestamp_format)).cast(f.dataType)
        elif isinstance(f.dataType, T.DateType) and src.date_format:
            parsed = F.try_to_timestamp(c, F.lit(src.date_format)).cast("date")
        elif isinstance(f.dataType, T.StringType):
            parsed = c
        else:
            parsed = c.try_cast(f.dataType)
        if not isinstance(f.dataType, T.StringType):
            bad.append(c.isNotNull() & parsed.isNull())
        out.append(parsed.alias(f.name))
    if corrupt:
        line = F.concat_ws(src.delimiter, *[F.coalesce(F.col(c), F.lit("")) for c in place])
        failed = reduce(lambda a, b: a | b, bad) if bad else F.lit(False)
        out.append(F.coalesce(F.col(CORRUPT), F.when(failed, line)).alias(CORRUPT))
    if path_column:
        out.append(F.col("_metadata.file_path").alias(path_column))
    return raw.select(*out)


def scan_csv_infer(spark: SparkSession, paths: str | list[str], header: bool = True,
                   delimiter: str = ",") -> DataFrame:
    """CSV with the schema inferred from the data (an extra pass over it)."""
    return (spark.read.format("csv").option("header", header).option("delimiter", delimiter)
            .option("inferSchema", True).load(paths))


def read_source(spark: SparkSession, source: SourceSpec | dict, business_date: str,
                schema: T.StructType, *, corrupt: bool = False) -> DataFrame:
    """One business date of a file source (the dated path) under ``schema``."""
    src = source if isinstance(source, SourceSpec) else SourceSpec.of(source)
    if src.type != "file":
        raise ValueError(f"Unsupported source type: {src.type}")
    return scan_csv(spark, dated_path(src, business_date), schema, src, corrupt=corrupt)


def _file_regex(file_format: str) -> tuple[str, dict[str, int]]:
    """Regex over a file name for the pattern, and the group of each date part."""
    pieces = re.split(r"(\{dd\}|\{MM\}|\{yyyy\})", file_format)
    regex, groups, g = "", {}, 0
    for p in pieces:
        if p in DATE_TOKENS:
            g += 1
            groups[p] = g
            regex += "([0-9]{4})" if p == "{yyyy}" else "([0-9]{2})"
        else:
            regex += re.escape(p)
    return regex, groups


def date_from_path(path: Column, file_format: str) -> Column:
    """The business date encoded in a drop's path by ``file_format``.

    The dated name is either the file itself or, when Spark wrote the drop,
    the folder holding its part files. A path that does not match gives NULL.
    """
    regex, groups = _file_regex(file_format.split("/")[-1])
    regex = "(?:^|/)" + regex + "(?:/[^/]*)?$"
    parts = [F.regexp_extract(path, regex, groups[t]) for t in ("{yyyy}", "{MM}", "{dd}")]
    return F.try_to_timestamp(F.concat_ws("-", *parts), F.lit("yyyy-MM-dd")).cast("date")


def _day_range(start: str, end: str) -> list[dt.date]:
    lo, hi = parse_business_date(start), parse_business_date(end)
    return [lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)]


def dated_glob(source: SourceSpec | dict, start: str | None = None, end: str | None = None,
               dates: Iterable[str] | None = None) -> str:
    """One glob for the drops of a date range or list (every drop when unbounded).

    Bounded days become a ``{name1,name2,...}`` alternation of the dated
    names, so the listing skips other days and days without a drop are simply
    absent (no path-not-found error).
    """
    src = source if isinstance(source, SourceSpec) else SourceSpec.of(source)
    base = src.path.rstrip("/")
    if dates is not None:
        days = sorted({parse_business_date(d) for d in dates})
    elif start is None or end is None:
        pattern = src.file_format
        for token, (_, glob) in DATE_TOKENS.items():
            pattern = pattern.replace(token, glob)
        return f"{base}/{pattern}"
    else:
        days = _day_range(start, end)
    names = []
    for day in days:
        name = src.file_format
        for token, (fmt, _) in DATE_TOKENS.items():
            name = name.replace(token, day.strftime(fmt))
        names.append(name)
    return f"{base}/{{{','.join(names)}}}" if len(names) > 1 else f"{base}/{names[0]}"


def scan_dated_files(spark: SparkSession, source: SourceSpec | dict, schema: T.StructType, *,
                     dates: Iterable[str] | None = None, start: str | None = None,
                     end: str | None = None, date_column: str = "business_date",
                     missing_ok: bool = False, corrupt: bool = False) -> DataFrame:
    """Many business dates in ONE scan, each row tagged with its file's date
    (by name: one scan per distinct header). ``corrupt`` as in :func:`scan_csv`.

    ``dates`` lists the days explicitly (each must exist unless
    ``missing_ok``); otherwise the drops of the ``start``..``end`` range
    (inclusive; either side open) are globbed, and rows are tagged with the
    date taken from their file's name.
    """
    src = source if isinstance(source, SourceSpec) else SourceSpec.of(source)
    if src.type != "file":
        raise ValueError(f"Unsupported source type: {src.type}")
    if dates is not None and not missing_ok:
        paths = [dated_path(src, d) for d in dates]
    else:
        paths = [dated_glob(src, start, end, dates)]
    df = scan_csv(spark, paths, schema, src, corrupt=corrupt, path_column="_bg_path")
    df = df.withColumn(date_column, date_from_path(F.col("_bg_path"), src.file_format)).drop("_bg_path")
    if start is not None:
        df = df.filter(F.col(date_column) >= F.lit(parse_business_date(start)))
    if end is not None:
        df = df.filter(F.col(date_column) <= F.lit(parse_business_date(end)))
    return df


_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4,
          T.DateType: 4, T.DecimalType: 16}


def row_width(schema: T.StructType, text_bytes: int = 0) -> int:
    """Estimated bytes per row: 16 of overhead, 8 per value unless known
    smaller, and ``text_bytes`` for every string/binary column."""
    def width(dt: T.DataType) -> int:
        if isinstance(dt, (T.StringType, T.BinaryType)):
            return text_bytes
        return next((w for k, w in _WIDTH.items() if isinstance(dt, k)), 8)
    return 16 + sum(width(f.dataType) for f in schema.fields)


def land(df: DataFrame, path: str, fmt: str = "parquet", flag: str | None = None) -> tuple[DataFrame, dict]:
    """Write a parsed batch once and return (re-read frame, counters).

    ``flag`` names a boolean column by which the copy is partitioned, so that
    either part is read alone; its true rows are counted as ``flagged``.

    Counters come from an observation of the write itself, so no extra scan:
    ``rows``, ``bytes`` (a measured size: fixed-width columns plus the actual
    length of every text value, used to bound broadcasts) and, if the frame
    has ``_corrupt_record``, ``corrupt_rows``.
    """
    obs = Observation("batchgate_land")
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema.fields
             if isinstance(f.dataType, (T.StringType, T.BinaryType)) and f.name != CORRUPT]
    terms = [F.count(F.lit(1)).alias("rows"),
             F.coalesce(F.sum(sum(texts[1:], texts[0])) if texts else F.lit(0), F.lit(0)).alias("text_bytes")]
    if CORRUPT in df.columns:
        terms.append(F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt_rows"))
    if flag is not None:
        terms.append(F.count_if(flag).alias("flagged"))
    writer = df.observe(obs, *terms).write.format(fmt).mode("errorifexists")
    (writer.partitionBy(flag) if flag is not None else writer).save(path)
    counters = {k: int(v or 0) for k, v in obs.get.items()}
    width = row_width(T.StructType([f for f in df.schema.fields if f.name != CORRUPT]))
    counters["bytes"] = counters.pop("text_bytes") + counters["rows"] * width
    # Read back under the known schema: no footer inference on the driver.
    return df.sparkSession.read.format(fmt).schema(df.schema).load(path), counters
