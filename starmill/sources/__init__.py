"""Readers of delivered files and the tables the loads write."""

from starmill.sources.buckets import BucketedTable
from starmill.sources.delimited import (
    absent_columns,
    delivered_files,
    delivery_name,
    delivery_names,
    period_of_path,
    read_delimited,
    read_table_export,
    require_columns,
)
from starmill.sources.ledger import FileLedger
from starmill.sources.scratch import clear_scratch, scratch_folder, written, written_apart
from starmill.sources.tables import BrokenRules, Tables, empty, read_or_empty

__all__ = [
    "BrokenRules",
    "BucketedTable",
    "FileLedger",
    "Tables",
    "absent_columns",
    "clear_scratch",
    "delivered_files",
    "delivery_name",
    "delivery_names",
    "empty",
    "period_of_path",
    "read_delimited",
    "read_or_empty",
    "read_table_export",
    "require_columns",
    "scratch_folder",
    "written",
    "written_apart",
]
