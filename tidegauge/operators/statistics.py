"""Volume statistics over the file catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge import rules
from tidegauge.functions.values import bytes_to_mb, json_text

STAT_KEYS = ["study_id", "subject_id", "modality", "is_protected", "is_raw"]


def json_tags(
    metadata: str = "metadata", sub_types: tuple[rules.SubType, ...] = rules.SUB_TYPES
) -> dict[str, Column]:
    """Tag columns read from the JSON of a stored catalogue."""
    return {key: json_text(metadata, key) for key in {s.key for s in sub_types}}


def flag_filter(files: DataFrame, is_protected: bool, is_raw: bool) -> DataFrame:
    return files.where(
        (F.col("is_protected") == is_protected) & (F.col("is_raw") == is_raw)
    )


def union_results(*parts: DataFrame) -> DataFrame:
    """Results of separate sources one after the other, duplicates kept, matched by column name.

    Flag combinations of one table need no union: grouping or filtering by the
    flags covers them in a single scan.
    """
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def volume_statistics(
    files: DataFrame,
    tags: dict[str, Column] | None = None,
    keys: list[str] | None = None,
    sub_types: tuple[rules.SubType, ...] = rules.SUB_TYPES,
    main_rows: bool = True,
) -> DataFrame:
    """File count and size per key, with an extra row for every sub-type that occurs.

    One aggregation: sub-types are conditional sums beside the totals and turn
    into rows only after the groups are formed, so no file row is duplicated
    before the shuffle and map-side combining sees each file once. Sizes are
    added as whole bytes, which makes the sum independent of the row order.
    """
    keys = keys or STAT_KEYS
    tags = json_tags(sub_types=sub_types) if tags is None else tags

    def hit(sub: rules.SubType) -> Column:
        return (
            (F.col("modality") == sub.modality)
            & F.col("is_protected")
            & F.col("is_raw")
            & tags[sub.key].contains(sub.value)
        )

    # The tag texts are tested once per file, ahead of the aggregation.
    flagged = files.select(
        *keys, "size_bytes", *[hit(sub).alias(f"hit{i}") for i, sub in enumerate(sub_types)]
    )
    size = F.col("size_bytes")
    sums = [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")]
    for i in range(len(sub_types)):
        sums.append(F.count_if(f"hit{i}").alias(f"n{i}"))
        sums.append(F.coalesce(F.sum(F.when(F.col(f"hit{i}"), size)), F.lit(0)).alias(f"b{i}"))

    def row(label: Column, count: str, volume: str) -> Column:
        return F.struct(
            label.alias("modality"),
            F.col(count).alias("files_count"),
            F.col(volume).alias("size_bytes"),
        )

    rows = [row(F.col("modality"), "n", "b")] if main_rows else []
    rows += [row(F.lit(s.label), f"n{i}", f"b{i}") for i, s in enumerate(sub_types)]
    present = F.filter(F.array(*rows), lambda r: r["files_count"] > 0)
    others = [k for k in keys if k != "modality"]
    return (
        flagged.groupBy(*keys)
        .agg(*sums)
        .select(*others, F.inline(present))
        .withColumn("files_size_mb", bytes_to_mb("size_bytes"))
    )


def summary_rollup(files: DataFrame) -> DataFrame:
    """Totals per network, study, subject and modality, with all higher levels.

    Files are first reduced to one row per finest group; the rollup then expands
    only those.
    """
    levels = ["network_id", "study_id", "subject_id", "modality"]
    finest = files.groupBy(*levels).agg(
        F.count(F.lit(1)).alias("n"), F.sum("size_bytes").alias("b")
    )
    return (
        finest.rollup(*levels)
        .agg(
            F.grouping_id().cast("int").alias("level"),
            F.sum("n").alias("files_count"),
            F.sum("b").alias("size_bytes"),
        )
        .withColumn("files_size_mb", bytes_to_mb("size_bytes"))
    )


def relative_mean(rows: DataFrame, group: str, entity: str, value: str) -> DataFrame:
    """Mean of each entity minus the mean of its group, for a whole-number value.

    Both means come from one pass over the rows: entity sums first, group sums
    from those. The join back is against one row per group.
    """
    entities = rows.groupBy(group, entity).agg(
        F.sum(value).alias("total"), F.count(value).alias("n")
    )
    groups = entities.groupBy(group).agg(
        (F.sum("total") / F.sum("n")).alias("group_mean")
    )
    return (
        entities.withColumn("entity_mean", F.col("total") / F.col("n"))
        .join(groups, group)
        .select(
            group,
            entity,
            "entity_mean",
            "group_mean",
            (F.col("entity_mean") - F.col("group_mean")).alias("relative_mean"),
        )
    )


def run_counts(**tables: DataFrame) -> DataFrame:
    """One (name, count) row per table, for the job log."""
    return union_results(
        *[
            table.agg(F.count(F.lit(1)).alias("found")).select(F.lit(name).alias("what"), "found")
            for name, table in tables.items()
        ]
    )
