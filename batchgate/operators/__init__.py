"""Data operators: rule registry, fused evaluation, audit, merge."""

from .audit import failure_audit, flag_failures, record_key, split_valid_invalid
from .merge import (MergeConflictError, bucket_expr, check_duplicate_matches, heavy_keys,
                    key_counts, merge_frames, merge_into, merge_metrics)
from .quality import (ValidationError, collect_results, evaluate, gate, summarize, validate)
from .rules import CompiledRule, compile_rules, register_rule, registered_rules

__all__ = [
    "CompiledRule", "MergeConflictError", "ValidationError", "bucket_expr",
    "check_duplicate_matches", "collect_results", "compile_rules", "evaluate", "failure_audit",
    "flag_failures", "gate", "heavy_keys", "key_counts", "merge_frames", "merge_into",
    "merge_metrics", "record_key", "register_rule", "registered_rules", "split_valid_invalid",
    "summarize", "validate",
]
