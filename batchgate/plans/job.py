"""The bronze load job: one entity, one business date.

Plan of a run::

    RUNNING event
    -> CSV parsed once, landed as parquet in the shared scratch folder
       (row count observed on that write, no extra scan)
    -> all rules in one fused aggregate + one grouped pass per unique key (shared
       with the audit, the split and the merge)
    -> gate (first FAIL raises), or failing rows to a quarantine table
    -> six metadata columns
    -> raw overwritten (merge mode) and merge / overwrite / append of master
    -> SUCCEEDED event with counters; on any error a FAILED event, then re-raise

The reference parses the CSV N + 4 times for N not-null columns; here the
text is parsed once whatever the number of rules.
"""

from __future__ import annotations

import datetime as dt
import logging
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.columns import with_metadata
from ..operators.audit import FAILED as ROW_FAILED
from ..operators.audit import FAILED_RULES, audit_table_rows, failure_audit, tag_failures, tag_repeated_keys
from ..operators.key_counts import KeyCounts
from ..operators.merge import own_rows
from ..operators.quality import collect_results, compile_for, evaluate, gate
from ..operators.rule_table import rules_from_table
from ..operators.rules import check_rule_names
from ..session import TableRef, scratch_path
from ..sources.files import CORRUPT, land, read_source, scan_csv
from ..spec import JobSpec, parse_business_date
from .runs import FAILED, SUCCEEDED, finish, latest_runs, new_run, record_event
from .sinks import append_once, append_table, write_target

log = logging.getLogger(__name__)


def source_schema(spark: SparkSession, spec: JobSpec) -> T.StructType:
    """Schema of the raw table minus metadata; the registry if not created yet."""
    if spec.raw is not None and spec.raw.exists(spark):
        return S.business_schema(spec.raw.read(spark).schema)
    table = (spec.raw.table or "") if spec.raw is not None else ""
    if table in S.ENTITY_COLUMNS:
        return S.entity_schema(table, with_metadata=False)
    raise ValueError(f"No schema for source of job '{spec.name}': raw table not found")


def earlier_runs(spark: SparkSession, control: TableRef | dict | str, job_name: str,
                 business_date: str, batch_id: int) -> dict[str, int]:
    """How many runs of this load the control table has, by their latest status."""
    ref = TableRef.of(control)
    if not ref.exists(spark):
        return {}
    events = ref.read(spark).filter(
        (F.col("job_name") == job_name) & (F.col("batch_id") == batch_id)
        & (F.col("business_date") == F.lit(business_date).cast("timestamp")))
    return {r["run_status"]: r["count"] for r in latest_runs(events).groupBy("run_status").count().collect()}


def already_loaded(spark: SparkSession, control: TableRef | dict | str, job_name: str,
                   business_date: str, batch_id: int) -> bool:
    """True when the control table has a SUCCEEDED run for this batch."""
    return SUCCEEDED in earlier_runs(spark, control, job_name, business_date, batch_id)


def run_job(spark: SparkSession, config: dict, batch_details: dict, *,
            schema: T.StructType | None = None, control: TableRef | dict | str | None = None,
            as_of: dt.datetime | str | None = None, job_run_id: int | None = None,
            landing_path: str | None = None,
            audit: TableRef | dict | str | None = None,
            skip_if_loaded: bool = False, paths: list[str] | None = None,
            rules_table: TableRef | dict | str | None = None,
            quarantine: TableRef | dict | str | None = None) -> dict[str, Any]:
    """Run one load; returns the run's counters and rule results.

    ``paths`` loads these files instead of the dated path (a stream's new
    files of one day). ``rules_table`` (or ``validation.rules_table`` of the
    config) names a table in the ``dq_rules`` layout whose active rules for
    this job are checked after the configured ones.

    With ``audit``, failing records are appended to that table (layout
    ``dq_failure_audit``) when any rule failed or warned -- before the gate,
    so a rejected batch leaves its evidence; a clean batch adds no rows.

    With ``quarantine`` (or ``target.quarantine``), rows that fail a rule go to that table with the names of
    the rules, and the others are loaded; only rules about the batch as a whole
    (row count, schema, misconfigured rules) still reject it. ``records_valid``
    and ``records_invalid`` are counts of the two parts.

    With ``skip_if_loaded`` (and ``control``) the load is exactly-once: a batch
    whose (job, business date, batch id) has a SUCCEEDED run is not loaded
    again, and one whose run died at any point, after its write too, leaves
    the tables and counters of a single run when it is run again. Rows are known
    by their batch id, business date and source, so a corrected batch needs
    a new batch id.
    """
    spec = JobSpec.of(config)
    business_date = batch_details["business_date"]
    parse_business_date(business_date)
    # One run time for every write of the run (raw, bronze, audit): the
    # query-time clock would differ between actions.
    as_of = as_of if as_of is not None else dt.datetime.now(dt.timezone.utc).isoformat(sep=" ")
    source_name = batch_details.get("source_name", spec.source.name)
    batch_id = batch_details["batch_id"]
    before = earlier_runs(spark, control, spec.name, business_date, batch_id) if control is not None else {}
    exactly_once = skip_if_loaded and control is not None
    if exactly_once and SUCCEEDED in before:
        return {"job_run_id": None, "run_status": "SKIPPED", "records_read": 0}
    run = new_run(spec.name, business_date, batch_id, source_name, spec.run_type, job_run_id,
                  retry_count=sum(n for status, n in before.items() if status != SUCCEEDED))
    # Without an earlier attempt nothing can stand in the tables already.
    done = own_rows(batch_id, business_date, source_name) if exactly_once and before else None
    quarantine = quarantine or spec.quarantine
    if control is not None:
        record_event(spark, control, run)
    known: dict[str, int] = {}
    try:
        schema = schema or source_schema(spark, spec)
        rules = list(spec.rules)
        if (stored := rules_table or spec.rules_table) is not None:
            rules += rules_from_table(TableRef.of(stored).read(spark), spec.name)
        check_rule_names(rules)
        parsed = (scan_csv(spark, paths, schema, spec.source, corrupt=True) if paths is not None
                  else read_source(spark, spec.source, business_date, schema, corrupt=True))
        if quarantine is not None:
            parsed = tag_failures(parsed, rules)
        landed_df, landed = land(parsed, landing_path or scratch_path(spark, "landing", spec.name),
                                 flag=ROW_FAILED if quarantine is not None else None)
        known["records_read"] = landed["rows"]
        # Rules see the landed copy with _corrupt_record (rule no_parse_errors);
        # everything written drops it.
        checked = landed_df.drop(FAILED_RULES, ROW_FAILED)
        counts = KeyCounts(checked)
        results = collect_results(evaluate(checked, rules, counts))
        if audit is not None and any(r["status"] != "PASS" for r in results):
            rows = failure_audit(checked, rules, spec.keys, counts)
            append_table(audit_table_rows(rows, run["job_run_id"], spec.name, source_name, business_date,
                                          spec.master.table or spec.master.label, as_of), audit)
        invalid = None
        if quarantine is None:
            gate(results)
            staged, valid_rows = checked.drop(CORRUPT), landed["rows"]
        else:
            gate([r for r in results if not _about_rows(checked, rules, r["rule_index"])])
            staged, invalid, valid_rows = _parts(spark, spec, landed_df, landed, rules, counts)
            if valid_rows < landed["rows"]:
                counts = KeyCounts(staged)               # of the rows that are loaded
        known["records_valid"], known["records_invalid"] = valid_rows, landed["rows"] - valid_rows

        def enriched(df):
            return with_metadata(df, batch_id, business_date, source_name, as_of)

        if invalid is not None and known["records_invalid"]:
            # First, so that a merge that cannot be done leaves its rejects behind; replays do not repeat them.
            rows = enriched(invalid.drop(CORRUPT, ROW_FAILED).withColumnRenamed(FAILED_RULES, "failed_rules"))
            if done is not None:
                append_once(rows, quarantine, done, known["records_invalid"], as_of)
            else:
                append_table(rows, quarantine)
        merged = write_target(spark, enriched(staged), spec.write_mode, spec.master, spec.raw, spec.keys,
                              as_of=as_of, buckets=spec.buckets, batch_rows=valid_rows,
                              batch_bytes=landed["bytes"], dedupe_by=spec.dedupe_by, layout=spec.layout,
                              counts=counts, done=done)
        ended = finish(run, SUCCEEDED, **known, **merged)
        if control is not None:
            record_event(spark, control, ended)
        return {"job_run_id": run["job_run_id"], "run_status": SUCCEEDED, **known,
                "corrupt_rows": landed.get("corrupt_rows", 0), **merged,
                "results": [r.asDict() for r in results]}
    except Exception as error:
        if control is not None:
            # What is known by now: rows read if the landing finished, valid and invalid ones if the gate was passed.
            event = finish(run, FAILED, error_summary=f"{type(error).__name__}: {error}", **known)
            try:
                record_event(spark, control, event)
            except Exception:
                log.exception("run %s failed, and its event could not be written", run["job_run_id"])
        raise


def _about_rows(df: DataFrame, rules: list[dict], index: int) -> bool:
    """Whether a rule's failures are rows that can be set aside (else they are about the batch as a whole)."""
    return compile_for(df, rules)[index].kind in ("row", "nulls", "unique")


def _parts(spark: SparkSession, spec: JobSpec, landed_df: DataFrame, landed: dict, rules: list[dict],
           counts: KeyCounts) -> tuple[DataFrame, DataFrame, int]:
    """Valid rows, invalid rows and the number of valid ones of a tagged batch.

    Row-level failures were tagged and counted while landing, and either part
    is a partition of the landed copy. Rows of repeated keys are known only
    after that; if there are any, the re-tagged rows are landed once more.
    """
    again = tag_repeated_keys(landed_df, rules, counts)
    if again is not None:
        landed_df, landed = land(again, scratch_path(spark, "landing", f"{spec.name}-keys"), flag=ROW_FAILED)
    valid = landed_df.where(~F.col(ROW_FAILED)).drop(ROW_FAILED, FAILED_RULES, CORRUPT)
    return valid, landed_df.where(ROW_FAILED), landed["rows"] - landed["flagged"]
