"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from ledgerwise.functions.columns import (
    any_differs,
    first_match,
    null_safe_differs,
    strict_date,
    strict_timestamp_ntz,
    ts_literal,
)

__all__ = [
    "any_differs",
    "first_match",
    "null_safe_differs",
    "strict_date",
    "strict_timestamp_ntz",
    "ts_literal",
]
