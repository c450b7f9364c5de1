"""Numeric helpers that make engine differences explicit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_ln(x) -> Column:
    """Natural log defined only for x > 0 (null otherwise).

    Engines disagree on ln(0) (null, -inf, error), so callers drop
    non-positive inputs instead of relying on any of them.
    """
    x = _c(x)
    return F.when(x > 0, F.ln(x))


def strip_text(x) -> Column:
    """Text without leading and trailing blanks and control characters
    (``0x00-0x20``), carriage returns of CRLF files included."""
    return F.regexp_replace(_c(x), r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def to_double(x) -> Column:
    """Lenient string -> double: non-numeric text (e.g. ``NA``) becomes null
    instead of failing the query under ANSI mode."""
    return F.expr(f"try_cast({x} as double)") if isinstance(x, str) else x.try_cast("double")
