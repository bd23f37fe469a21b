"""Job plans: sinks, run control, the bronze load job."""

from .job import run_job, source_schema
from .runs import (FAILED, RUNNING, SUCCEEDED, events_frame, finish, latest_runs, new_run,
                   record_event)
from .sinks import append_table, overwrite_table, write_target

__all__ = ["FAILED", "RUNNING", "SUCCEEDED", "append_table", "events_frame", "finish",
           "latest_runs", "new_run", "overwrite_table", "record_event", "run_job",
           "source_schema", "write_target"]
