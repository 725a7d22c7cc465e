"""Small tables for the operators of the training-data package."""

from __future__ import annotations

import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Build documents from (doc_id, text[, source]) rows."""

    def build(rows, extra=False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0) for r in rows]
        table = spark.createDataFrame(full, DOCUMENTS)
        if extra:
            from pyspark.sql import functions as F

            for name in ("row_id", "words", "key", "fp", "doc", "row", "taken", "at", "score"):
                table = table.withColumn(name, F.lit(name))
        return table

    return build


@pytest.fixture(scope="session")
def odd(documents):
    """Null, empty, blank, very long, repeated and equal texts, a null id, an id that is used twice."""
    long = " ".join(random.Random(5).choices(["red", "green", "blue", "of", "Ünder"], k=30_000))
    same = "one two three four five six seven eight nine ten eleven twelve " * 3
    return documents(
        [
            (1, None),
            (2, ""),
            (3, " \t\n "),
            (4, long, None),
            (5, same),
            (5, same),
            (6, same + "end", "t"),
            (6, "another text with the same id"),
            (None, "words without an id", "t"),
            (7, "!!! ???"),
            (8, "ÀÉ naïve 日本語 text"),
        ],
        extra=True,
    )
