"""Readers and writers: CSV uploads, JDBC tables, parquet in the shared folder."""

import sys

from pyspark import cloudpickle

from upcheck.sources.csv import (
    QUOTED_EMPTY_MARKER,
    header_index,
    read_csv_groups,
    read_upload_csv,
    write_csv,
)
from upcheck.sources.jdbc import jdbc_options, read_jdbc_table, jdbc_target_schema
from upcheck.sources.ledger import Ledger
from upcheck.sources.storage import discard, materialize, tracked, write_table

__all__ = [
    "Ledger", "QUOTED_EMPTY_MARKER", "discard", "header_index", "jdbc_options", "jdbc_target_schema", "materialize",
    "read_csv_groups", "read_jdbc_table", "read_upload_csv", "tracked", "write_csv", "write_table",
]

# functions that tasks run travel by value, so workers need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
