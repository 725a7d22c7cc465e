"""Key-based merging of new rows into a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedupe_latest(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by `order`.

    Spark turns the filter on the row number into a per-task limit ahead of the
    shuffle, so a key with very many rows sends one row per task.
    """
    newest = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in order])
    return (
        rows.withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def upsert(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Existing rows whose key is not replaced, and all new rows (unique on the key)."""
    kept = existing.join(new.select(*key), key, "left_anti")
    return kept.select(*new.columns).unionByName(new)


def insert_conflicts(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """New keys that cannot be inserted: taken already, or given more than once.

    The new keys are counted first, so a key given very often is one row in the
    join; `existing` is unique on the key.
    """
    offered = new.groupBy(*key).agg(F.count(F.lit(1)).alias("offered"))
    taken = existing.select(*key, F.lit(True).alias("_taken"))
    return (
        offered.join(taken, key, "left")
        .withColumn("exists", F.coalesce("_taken", F.lit(False)))
        .where(F.col("exists") | (F.col("offered") > 1))
        .select(*key, "offered", "exists")
    )
