"""A check: a Spark query over the test tables and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from suite.frames import Frames


@dataclass(frozen=True)
class Check:
    query: Callable[[Frames], DataFrame]
    sql: str | None = None
