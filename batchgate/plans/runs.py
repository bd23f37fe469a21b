"""Job-run control: run events appended, latest state folded per run.

File tables cannot UPDATE a row, so a run is an append-only series of events
(RUNNING, then SUCCEEDED or FAILED) and the control view is the latest event
per ``job_run_id``, picked with ``max_by`` -- a partial aggregate, so a run
with a huge number of events is still folded map-side. Table formats with
row-level DML get a bound-parameter ``UPDATE`` instead (no quoting of error
text into SQL).
"""

from __future__ import annotations

import datetime as dt
import time
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..session import TableRef
from .sinks import append_table

RUNNING, SUCCEEDED, FAILED = "RUNNING", "SUCCEEDED", "FAILED"
EVENT_SEQ = "event_seq"
EVENT_SCHEMA = T.StructType(S.JOB_RUN_CONTROL.fields + [T.StructField(EVENT_SEQ, T.IntegerType(), False)])
FINISH_FIELDS = ("run_status", "finished_at", "records_read", "records_valid", "records_invalid",
                 "records_inserted", "records_updated", "records_merged", "error_summary", "updated_at")


def _now() -> dt.datetime:
    return dt.datetime.now()


def new_run(job_name: str, business_date: str, batch_id: int, source_name: str | None = None,
            run_type: str | None = None, job_run_id: int | None = None,
            now: dt.datetime | None = None, retry_count: int = 0) -> dict:
    """The RUNNING event of a new run as a dict of control columns (``retry_count``: earlier runs of
    the same load that did not succeed)."""
    started = now or _now()
    return {
        "job_run_id": job_run_id if job_run_id is not None else time.time_ns(),
        "job_name": job_name,
        "source_name": source_name,
        # Kept as text and cast by Spark (midnight in the session's zone, like
        # the batch metadata); a naive Python datetime would take the driver
        # process's zone instead.
        "business_date": dt.datetime.strptime(business_date, "%Y-%m-%d").strftime("%Y-%m-%d"),
        "batch_id": batch_id,
        "run_status": RUNNING,
        "run_type": run_type,
        "started_at": started,
        "finished_at": None,
        "records_read": None, "records_valid": None, "records_invalid": None,
        "records_inserted": None, "records_updated": None, "records_merged": None,
        "error_summary": None,
        "retry_count": retry_count,
        "created_at": started,
        "updated_at": started,
        EVENT_SEQ: 0,
    }


def finish(run: dict, status: str, *, now: dt.datetime | None = None, **counters: Any) -> dict:
    """The closing event of a run: status, finish time, counters, error text."""
    ended = now or _now()
    out = dict(run)
    out.update({"run_status": status, "finished_at": ended, "updated_at": ended,
                EVENT_SEQ: run.get(EVENT_SEQ, 0) + 1})
    for k in ("records_read", "records_valid", "records_invalid", "records_inserted",
              "records_updated", "records_merged", "error_summary"):
        if k in counters:
            v = counters[k]
            out[k] = None if v is None else (str(v) if k == "error_summary" else int(v))
    return out


def events_frame(spark: SparkSession, events: list[dict]) -> DataFrame:
    names = EVENT_SCHEMA.fieldNames()
    as_text = T.StructType([T.StructField(f.name, T.StringType(), f.nullable) if f.name == "business_date" else f
                            for f in EVENT_SCHEMA.fields])
    frame = spark.createDataFrame([tuple(e[n] for n in names) for e in events], as_text)
    return frame.withColumn("business_date", F.col("business_date").cast("timestamp"))


def record_event(spark: SparkSession, control: TableRef | dict | str, event: dict) -> None:
    """Persist one run event (append; UPDATE for row-level-DML formats)."""
    ref = TableRef.of(control)
    if event[EVENT_SEQ] > 0 and ref.supports_row_level_dml() and ref.exists(spark):
        sets = ", ".join(f"{k} = :{k}" for k in FINISH_FIELDS)
        args = {k: event[k] for k in FINISH_FIELDS}
        args["job_run_id"] = event["job_run_id"]
        spark.sql(f"UPDATE {ref.name} SET {sets} WHERE job_run_id = :job_run_id", args=args)
        return
    frame = events_frame(spark, [event])
    if ref.supports_row_level_dml():
        frame = frame.drop(EVENT_SEQ)
    elif ref.exists(spark):
        # A table provisioned from the control DDL has no event_seq column.
        frame = frame.select(*[c for c in frame.columns if c in set(ref.read(spark).columns)])
    append_table(frame, ref)


def latest_runs(events: DataFrame, run_id: str = "job_run_id",
                order: tuple[str, ...] | None = None) -> DataFrame:
    """Latest event per run (the control view), by the ``order`` columns.

    Default order: ``updated_at``, then ``event_seq`` when the table has it,
    else the status (a final status after RUNNING at the same instant).
    """
    cols = events.columns
    if order is None:
        tie = F.col(EVENT_SEQ) if EVENT_SEQ in cols else (F.col("run_status") != RUNNING).cast("int")
        order_cols = [F.col("updated_at"), tie]
    else:
        order_cols = [F.col(c) for c in order]
    return (events.groupBy(run_id)
                  .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*order_cols)).alias("_s"))
                  .select("_s.*"))
