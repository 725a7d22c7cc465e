"""Growth between consecutive snapshots."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge import rules
from tidegauge.functions.text import normalise_network
from tidegauge.functions.times import short_date, weekend_band
from tidegauge.functions.values import bytes_to_mb
from tidegauge.operators.scope import scoped
from tidegauge.operators.snapshots import TS, since

SERIES = ["network_id", "modality"]


def stats_with_study(stats: DataFrame, study: DataFrame) -> DataFrame:
    """Statistics with the study's columns; rows of unknown studies stay."""
    return stats.join(study, "study_id", "left")


def stats_of_networks(stats: DataFrame, study: DataFrame) -> DataFrame:
    """Statistics of known networks.

    A filter on the network follows every outer join to studies, so the join is
    inner; the subject table adds neither columns nor rows and is left out.
    """
    return stats.join(study.select("study_id", "network_id"), "study_id")


def _sums() -> list[Column]:
    return [F.sum("files_count").alias("files_count"), F.sum("size_bytes").alias("size_bytes")]


def _per_study(stats: DataFrame) -> DataFrame:
    """Scoped statistics reduced to studies, ahead of any join."""
    return scoped(stats).groupBy("study_id", "modality", TS).agg(*_sums())


def flow_totals_all(stats: DataFrame) -> DataFrame:
    """Files and size per modality and snapshot over all networks."""
    totals = scoped(stats).groupBy("modality", TS).agg(*_sums())
    return totals.withColumn("files_size_mb", bytes_to_mb("size_bytes"))


def flow_totals(stats: DataFrame, study: DataFrame) -> DataFrame:
    """Files and size per modality and snapshot, for each network and for all together."""
    sets = [["network_id", "modality", TS], ["modality", TS]]
    totals = (
        stats_with_study(_per_study(stats), study.select("study_id", "network_id"))
        .groupingSets(sets, "network_id", "modality", TS)
        .agg(F.grouping("network_id").alias("is_total"), *_sums())
    )
    return (
        totals.where((F.col("is_total") == 1) | F.col("network_id").isNotNull())
        .withColumn(
            "network_id",
            F.when(F.col("is_total") == 1, rules.ALL_NETWORKS).otherwise(F.col("network_id")),
        )
        .drop("is_total")
        .withColumn("files_size_mb", bytes_to_mb("size_bytes"))
    )


def flow_diffs(totals: DataFrame) -> DataFrame:
    """Growth since the snapshot before, per network and modality; null for the first."""
    previous = Window.partitionBy(*SERIES).orderBy(TS)
    files, size = F.col("files_count"), F.col("size_bytes")
    grown = size - F.lag("size_bytes").over(previous)
    return totals.select(
        *SERIES,
        TS,
        files.alias("files_count"),
        "files_size_mb",
        (files - F.lag("files_count").over(previous)).alias("files_count_diff"),
        grown.alias("size_bytes_diff"),
        bytes_to_mb(grown).alias("files_size_mb_diff"),
    )


def flow_scale(diffs: DataFrame) -> DataFrame:
    """Upper axis limit and label height of each series."""

    def top(column: str, factor: float) -> Column:
        return F.max(column).cast("double") * F.lit(factor)

    return diffs.groupBy(*SERIES).agg(
        F.max("files_count_diff").alias("max_files"),
        F.max("files_size_mb_diff").alias("max_size_mb"),
        top("files_size_mb_diff", rules.AXIS_HEADROOM).alias("size_axis_top"),
        top("files_count_diff", rules.WEEKEND_LABEL_SHARE).alias("files_label_at"),
        top("files_size_mb_diff", rules.WEEKEND_LABEL_SHARE).alias("size_label_at"),
    )


def flow_series(
    stats: DataFrame,
    study: DataFrame,
    as_of: date | Column,
    days: int = rules.DEFAULT_DAYS,
    modality: str | None = None,
    network: str | None = None,
) -> DataFrame:
    """Chart-ready growth series over the trailing days.

    With a modality and a network this is one chart; without them, all charts
    at once. The first point of a series has no growth. Two runs in one day are
    two points of the same day.
    """
    if modality is not None and modality not in rules.KNOWN_MODALITIES:
        raise ValueError(f"unknown modality {modality!r}; known: {rules.KNOWN_MODALITIES}")
    day = as_of if isinstance(as_of, Column) else F.lit(as_of)
    recent = since(stats, F.date_sub(day, days))
    if modality is not None:
        recent = recent.where(F.col("modality") == modality)
    totals = flow_totals(recent, study)
    if network is not None:
        totals = totals.where(F.col("network_id") == normalise_network(F.lit(network)))
    return decorate_series(flow_diffs(totals))


def decorate_series(diffs: DataFrame) -> DataFrame:
    """Day, axis text, legend text and weekend band of every point of a series."""
    band = weekend_band("day")
    return diffs.withColumn("day", F.col(TS).cast("date")).select(
        "*",
        F.upper("modality").alias("label"),
        short_date("day").alias("day_label"),
        band.start.alias("band_start"),
        band.end.alias("band_end"),
        band.label_at.alias("band_label_at"),
    )


def weekend_bands(days: DataFrame, day: str = "day") -> DataFrame:
    """One band for each Saturday among the days."""
    band = weekend_band(day)
    return (
        days.select(F.col(day))
        .distinct()
        .select(
            day,
            band.start.alias("band_start"),
            band.end.alias("band_end"),
            band.label_at.alias("band_label_at"),
        )
        .where(F.col("band_start").isNotNull())
    )
