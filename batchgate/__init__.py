"""batchgate: daily batch ingestion with fused data-quality rules on Spark.

Load dated CSV drops under an explicit schema, check them with a registry of
rules evaluated in one pass, audit failing rows, add batch metadata, and
append, overwrite or merge into versioned current-state tables while
tracking each run.
"""

from .functions import prepared_projection, project_to_schema, with_metadata
from .jobs import entity_job
from .operators import (evaluate, failure_audit, gate, merge_frames, merge_into, register_rule,
                        split_valid_invalid, summarize, validate)
from .plans import latest_runs, run_job
from .session import TableRef, checkpoint_root, scratch_path
from .sources import land, read_source, scan_csv, scan_dated_files
from .spec import JobSpec, normalize_rules

__all__ = [
    "JobSpec", "TableRef", "checkpoint_root", "entity_job", "evaluate", "failure_audit", "gate",
    "land", "latest_runs", "merge_frames", "merge_into", "normalize_rules", "prepared_projection",
    "project_to_schema", "read_source", "register_rule", "run_job", "scan_csv", "scan_dated_files",
    "scratch_path", "split_valid_invalid", "summarize", "validate", "with_metadata",
]
