"""Consented and recruited subjects per network and cohort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge import rules
from tidegauge.functions.times import long_date


def recruitment_join(
    status: DataFrame, subjects: DataFrame, sites: DataFrame, filters: DataFrame
) -> DataFrame:
    """Status rows with site and cohort.

    The three subject-level tables meet on the subject first, so each is
    shuffled once on the same key; the sites follow as the small side.
    """
    by_subject = status.join(subjects, status["subject_id"] == subjects["id"]).join(
        filters, status["subject_id"] == filters["subject"]
    )
    return by_subject.join(sites, subjects["site_id"] == sites["id"]).select(
        status["*"],
        subjects["site_id"],
        sites["site_name"],
        sites["site_country"],
        sites["network_id"],
        sites["site_country_code"],
        filters["cohort"],
    )


def _skeleton(
    some_rows: DataFrame, networks: tuple[str, ...], cohorts: tuple[str, ...]
) -> DataFrame:
    pairs = [
        F.struct(
            F.lit(i).alias("network_order"),
            F.lit(n).alias("network_id"),
            F.lit(j).alias("cohort_order"),
            F.lit(c).alias("cohort"),
        )
        for i, n in enumerate(networks)
        for j, c in enumerate(cohorts)
    ]
    # An aggregate without keys gives one row even when there is no input.
    one = some_rows.limit(0).agg(F.count(F.lit(1)).alias("n"))
    return one.select(F.inline(F.array(*pairs)))


def recruitment_counts(
    joined: DataFrame,
    networks: tuple[str, ...] = rules.NETWORKS,
    cohorts: tuple[str, ...] = rules.COHORTS,
) -> DataFrame:
    """Consented and recruited counts; pairs without subjects show zeros."""
    counted = (
        joined.where(F.col("network_id").isin(*networks) & F.col("cohort").isin(*cohorts))
        .groupBy("network_id", "cohort")
        .agg(
            F.count(F.lit(1)).alias("consented"),
            F.count_if(F.col("recruitment_status") == rules.RECRUITED).alias("recruited"),
        )
    )
    return (
        _skeleton(joined, networks, cohorts)
        .join(counted, ["network_id", "cohort"], "left")
        .select(
            "network_order",
            "network_id",
            "cohort_order",
            "cohort",
            F.coalesce("consented", F.lit(0)).alias("consented"),
            F.coalesce("recruited", F.lit(0)).alias("recruited"),
        )
    )


def recruitment_lines(counts: DataFrame, as_of: Column) -> DataFrame:
    """The recruitment message as rows, to be shown in order of the `*_order` columns.

    Every line is made from a row of counts: the first pair of a network also
    carries the network line, the first pair of all carries the title.
    """

    def line(order: int, indent: int, text: Column, only: Column | None = None) -> Column:
        entry = F.struct(
            F.lit(order).alias("line_order"),
            F.lit(indent).alias("indent"),
            text.cast("string").alias("text"),
        )
        return entry if only is None else F.when(only, entry)

    first_cohort = F.col("cohort_order") == 0
    first_of_all = first_cohort & (F.col("network_order") == 0)
    title = F.concat(F.lit("Recruitment Status as of "), long_date(as_of))
    lines = F.array_compact(
        F.array(
            line(0, 0, title, first_of_all),
            line(1, 0, F.col("network_id"), first_cohort),
            line(2, 0, F.col("cohort")),
            line(3, 1, F.concat(F.lit("Consented: "), F.col("consented").cast("string"))),
            line(4, 1, F.concat(F.lit("Recruited: "), F.col("recruited").cast("string"))),
        )
    )
    return counts.select("network_order", "cohort_order", F.inline(lines))
