"""Structured Streaming ingestion of uploads (file discovery, routing, foreachBatch)."""

import sys

from pyspark import cloudpickle

from upcheck.streaming.holds import settled, start_holds, state_store, verdicts
from upcheck.streaming.ingest import (
    Route,
    compact_sink,
    discover_files,
    make_batch_handler,
    read_rejected,
    read_sink,
    route_files,
    start_ingest,
)

__all__ = ["Route", "compact_sink", "discover_files", "make_batch_handler", "read_rejected",
           "read_sink", "route_files", "settled", "start_holds", "start_ingest", "state_store", "verdicts"]

# the state processor travels by value, so workers need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
