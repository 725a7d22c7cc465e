"""Finding snapshots in the statistics table."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TS = "statistics_timestamp"
DAY = "snapshot_date"


def ntz(value: datetime | Column) -> Column:
    """A zone-less timestamp literal in UTC, or the column as it is."""
    if isinstance(value, Column):
        return value
    if value.tzinfo is not None:
        value = value.astimezone(UTC).replace(tzinfo=None)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def latest_snapshot(runs: DataFrame) -> DataFrame:
    """The newest time among runs: the index of stored snapshots, or any table with their time."""
    return runs.agg(F.max(TS).alias(TS))


def earlier_snapshots(runs: DataFrame, before: datetime | Column, depth: int = 1) -> DataFrame:
    """The `depth` newest snapshots before a threshold, as (steps_back, timestamp).

    A top-k on distinct timestamps, so no task sorts them all.
    """
    known = runs.select(TS).where(F.col(TS) < ntz(before)).distinct()
    newest = known.orderBy(F.desc(TS)).limit(depth)
    ordered = newest.agg(F.sort_array(F.collect_list(TS), asc=False).alias("found"))
    return ordered.select(F.posexplode("found").alias("steps_back", TS))


def nth_previous_snapshot(
    runs: DataFrame, before: datetime | Column, offset: int = 0
) -> DataFrame:
    """The snapshot `offset` steps before the newest one older than `before`; may be empty."""
    known = runs.select(TS).where(F.col(TS) < ntz(before)).distinct()
    return known.orderBy(F.desc(TS)).offset(offset).limit(1)


def earlier_snapshot_of_each(
    thresholds: DataFrame, runs: DataFrame, at: str, offsets: int = 1
) -> DataFrame:
    """For every threshold, the snapshots 0 to `offsets` - 1 steps before the newest older one.

    `at` is the threshold's column; its rows come back with `steps_back` and the time of the
    `earlier_snapshot`, null where there is none so early. A null threshold has none at all.

    Snapshots are numbered in the order of time. A threshold's number is that of the snapshots
    before its day, carried on from day to day over days with snapshots or thresholds, and of
    the earlier ones of its own day; the snapshot of each number is then an equality join. Only
    days and snapshots are ever sorted together; thresholds are joined, and Spark splits a hot day.
    """
    known = runs.select(TS).where(F.col(TS).isNotNull()).distinct()
    day = F.col(at).cast("date")
    held = known.groupBy(F.col(TS).cast("date").alias("_day")).agg(F.collect_list(TS).alias("_held"))
    asked = thresholds.select(day.alias("_day")).where(F.col("_day").isNotNull()).distinct()
    days = asked.join(held, "_day", "full")
    earlier = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    size = F.coalesce(F.size("_held"), F.lit(0))
    counted = days.select(
        "_day",
        F.coalesce("_held", F.array().cast("array<timestamp_ntz>")).alias("_held"),
        F.coalesce(F.sum(F.greatest(size, F.lit(0))).over(earlier), F.lit(0)).alias("_before"),
    )
    number = F.row_number().over(Window.orderBy(TS))
    numbered = known.select(number.alias("_number"), F.col(TS).alias("earlier_snapshot"))
    placed = thresholds.withColumn("_day", day).join(counted, "_day", "left")
    moment = F.col(at).cast("timestamp_ntz")
    own = F.size(F.filter("_held", lambda held: held < moment))
    steps = F.explode(F.sequence(F.lit(0), F.lit(offsets - 1))).alias("steps_back")
    each = placed.select(*thresholds.columns, (F.col("_before") + own).alias("_upto"), steps)
    each = each.withColumn("_number", (F.col("_upto") - F.col("steps_back")).cast("int"))
    found = each.join(numbered, "_number", "left")
    return found.select(*thresholds.columns, "steps_back", "earlier_snapshot")


def at_snapshots(stats: DataFrame, *moments: Column) -> DataFrame:
    """Rows of the given snapshots: pruned by date where partitioned, exact on the timestamp."""
    if DAY in stats.columns:
        stats = stats.where(F.col(DAY).isin(*[m.cast("date") for m in moments]))
    return stats.where(F.col(TS).isin(*moments))


def since(stats: DataFrame, first_day: Column) -> DataFrame:
    """Rows from midnight of a day on."""
    if DAY in stats.columns:
        stats = stats.where(F.col(DAY) >= first_day)
    return stats.where(F.col(TS) >= first_day.cast("timestamp_ntz"))
