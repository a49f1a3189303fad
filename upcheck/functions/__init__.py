"""Column-level building blocks (all JVM-side built-in expressions)."""

from upcheck.functions.text import (
    extract_int,
    invalid_token,
    normalise_token,
    strip_ws,
    token_pattern,
)
from upcheck.functions.names import clean_column_name

__all__ = [
    "clean_column_name",
    "extract_int",
    "invalid_token",
    "normalise_token",
    "strip_ws",
    "token_pattern",
]
