"""Continuous form of the load: file drops picked up by Structured Streaming.

Nothing here is a new operator, and there is no second load path: the stream
only lists newly arrived files (their content is not read by the stream), and
each micro-batch hands the new files of one business date after the other,
oldest first, to :func:`batchgate.plans.job.run_job`. Header checks, binding,
parse failures, rules, write modes, raw table, audit and run events, FAILED ones
included, are therefore those of a batch run.
"""

from __future__ import annotations

import zlib
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.job import run_job
from ..session import TableRef, scratch_path
from ..sources.files import date_from_path
from ..spec import JobSpec

_FILES = "path string, modificationTime timestamp, length long, content binary"


def load_id(checkpoint: str, micro_batch: int) -> int:
    """Batch id of a micro-batch. Micro-batch numbers start at 0 under every new
    checkpoint, so the checkpoint, which identifies the query, is part of it."""
    return (zlib.crc32(checkpoint.rstrip("/").encode()) << 31) | micro_batch


def stream_loads(spark: SparkSession, config: dict, schema: T.StructType, source_name: str,
                 *, checkpoint: str | None = None, trigger_once: bool = True,
                 control: TableRef | dict | str | None = None,
                 audit: TableRef | dict | str | None = None, as_of: str | None = None) -> Any:
    """Start a query loading every new file under ``source.path``.

    The business date of a file is the date in its name. ``foreachBatch`` is
    at-least-once: with ``control``, a micro-batch replayed under the same
    checkpoint finds its SUCCEEDED runs and skips them, so versions are not
    bumped twice; another checkpoint is another query, whose loads are its own.
    Returns the ``StreamingQuery``.
    """
    spec = JobSpec.of(config)
    src = spec.source
    checkpoint = checkpoint or scratch_path(spark, "stream", spec.name)
    names = (spark.readStream.format("binaryFile").schema(_FILES)
             .option("pathGlobFilter", "*.csv" if src.format == "csv" else "*").load(src.path)
             .select("path", date_from_path(F.col("path"), src.file_format).alias("day")))

    def load_batch(batch: DataFrame, micro_batch: int) -> None:
        # One row per new file of the trigger.
        files: dict[str, list[str]] = {}
        for row in batch.collect():
            if row["day"] is None:
                raise ValueError(f"no business date in the file name {row['path']} (pattern {src.file_format})")
            files.setdefault(str(row["day"]), []).append(row["path"])
        for day in sorted(files):
            run_job(spark, config, {"business_date": day, "batch_id": load_id(checkpoint, micro_batch), "source_name": source_name},
                    schema=schema, control=control, audit=audit, as_of=as_of, paths=sorted(files[day]),
                    skip_if_loaded=control is not None)

    writer = names.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger_once else writer
    return writer.start()
