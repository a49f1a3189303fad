"""upcheck: reconcile and validate tabular uploads against reference data on Spark.

Every operator is a composition of DataFrame joins, aggregations and built-in
column expressions, so Catalyst plans it and AQE re-plans it at run time.
"""

from upcheck.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
