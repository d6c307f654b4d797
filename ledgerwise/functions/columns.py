"""Column expressions shared by the operators.

Parsing never raises under ANSI mode and never depends on the session time
zone: text must first match the exact shape (``yyyy-MM-dd`` /
``yyyy-MM-ddTHH:mm:ss``), then ``try_cast`` to DATE / TIMESTAMP_NTZ turns
impossible calendar values into NULL.
"""

from __future__ import annotations

from datetime import date, datetime, timezone
from typing import Iterable, Sequence, Tuple, Union

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerwise import constants as C

ColumnOrName = Union[Column, str]


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_date(c: ColumnOrName) -> Column:
    """``yyyy-MM-dd`` text to DATE; anything else (including impossible
    calendar dates) becomes NULL instead of failing the job."""
    c = _col(c)
    # The shape check pins the text to yyyy-MM-dd, so the cast's own parser
    # (cheaper than a pattern formatter) gives the same result.
    return F.when(c.rlike(C.DATE_PATTERN), c.try_cast("date"))


def strict_timestamp_ntz(c: ColumnOrName) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` text to TIMESTAMP_NTZ, zone-free; other shapes
    (zone suffix, 24:00:00, Feb 30, blanks) become NULL."""
    c = _col(c)
    return F.when(c.rlike(C.TIMESTAMP_PATTERN), c.try_cast("timestamp_ntz"))


def ts_literal(value: Union[str, datetime, date]) -> Column:
    """A TIMESTAMP_NTZ literal. Aware datetimes are normalised to UTC first."""
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, date):
        text = value.strftime("%Y-%m-%d 00:00:00")
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


def null_safe_differs(a: ColumnOrName, b: ColumnOrName) -> Column:
    """True when the two values differ, NULL counting as a value."""
    return ~_col(a).eqNullSafe(_col(b))


def any_differs(pairs: Iterable[Tuple[ColumnOrName, ColumnOrName]]) -> Column:
    """OR-fold of :func:`null_safe_differs` over (left, right) pairs."""
    out = None
    for a, b in pairs:
        term = null_safe_differs(a, b)
        out = term if out is None else (out | term)
    return out if out is not None else F.lit(False)


def first_match(rules: Sequence[Tuple[Column, str]], default: str) -> Column:
    """One label per row: the label of the first rule whose predicate holds."""
    expr = None
    for predicate, label in rules:
        expr = F.when(predicate, F.lit(label)) if expr is None else expr.when(predicate, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)
