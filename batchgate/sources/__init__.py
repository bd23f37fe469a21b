"""Sources: dated CSV files, backfills, landing, catalog tables."""

from .files import (CORRUPT, HeaderMismatchError, dated_path, header_report, land, read_source, scan_csv,
                    scan_csv_infer, scan_dated_files)
from .tables import scan_table, table_schema

__all__ = ["CORRUPT", "HeaderMismatchError", "dated_path", "header_report", "land", "read_source", "scan_csv", "scan_csv_infer",
           "scan_dated_files", "scan_table", "table_schema"]
