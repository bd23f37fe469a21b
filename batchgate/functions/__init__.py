"""Column builders: row predicates and projections."""

from .columns import (as_of_column, drop_columns, drop_metadata, parse_timestamp,
                      prepared_projection, projection_with_rejects, project_to_schema, with_metadata)
from .predicates import (DIGITS_ONLY, any_null, any_true, check_violated, is_null,
                         length_outside, not_digits, not_in, not_null, null_safe,
                         outside_range)

__all__ = [
    "DIGITS_ONLY", "any_null", "any_true", "as_of_column", "check_violated", "drop_columns",
    "drop_metadata", "is_null", "length_outside", "not_digits", "not_in", "not_null",
    "null_safe", "outside_range", "parse_timestamp", "prepared_projection", "project_to_schema",
    "with_metadata",
]
