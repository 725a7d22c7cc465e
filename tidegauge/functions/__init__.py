"""Scalar operators as Column builders; all of them stay inside JVM code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value: str | Column) -> Column:
    """A column given by name or as an expression."""
    return F.col(value) if isinstance(value, str) else value
