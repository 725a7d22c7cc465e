"""Checks over snapshots: growth series, comparisons, alerts, message lines."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from suite.check import Check
from suite.frames import NETWORKS, Frames
from suite.sql import MB, SCOPE, binary_size, sql
from tidegauge.operators import delta, flow, lookups, scope, snapshots
from tidegauge.plans.reports import snapshot_pair
from tidegauge.sinks import tables

TS = snapshots.TS


def _latest(f: Frames) -> Column:
    return snapshots.latest_snapshot(f.runs()).scalar()


def stats_study_join(f: Frames) -> DataFrame:
    return flow.stats_with_study(f.snapshots(), f.study()).select(
        "study_id", "modality", "is_protected", "is_raw", TS, "files_count", "study_country", "network_id"
    )


def stats_subject_study_join(f: Frames) -> DataFrame:
    return flow.stats_of_networks(f.snapshots(), f.study()).select(
        "network_id", "study_id", "subject_id", "modality", "is_protected", "is_raw", TS, "size_bytes"
    )


def is_true_filter(f: Frames) -> DataFrame:
    """Flags tested so that an unknown one is neither true nor false."""
    flags = f.snapshots().select(
        "study_id",
        "modality",
        TS,
        "is_protected",
        F.when(F.col("modality") != "mri", F.col("is_raw")).alias("is_raw"),
    )
    return flags.where(scope.in_scope(scopes={}))


def trailing_window(f: Frames) -> DataFrame:
    rows = snapshots.since(f.snapshots(), F.date_sub(_latest(f).cast("date"), 365))
    return rows.select("study_id", "modality", "is_protected", "is_raw", TS, "files_count")


def totals(f: Frames) -> DataFrame:
    return flow.flow_totals(f.snapshots(), f.study())


def diffs(f: Frames) -> DataFrame:
    return flow.flow_diffs(totals(f))


def flow_series(f: Frames) -> DataFrame:
    last = f.table("events").agg(F.max("ts")).scalar().cast("date")
    return flow.flow_series(f.daily_statistics(), f.study(), last)


def weekend_bands(f: Frames) -> DataFrame:
    return flow.weekend_bands(f.daily(), "snapshot_date")


def report(f: Frames) -> DataFrame:
    """Only the two newest snapshots are read, and no file row for the modalities."""
    runs = f.runs()
    pair = snapshot_pair(runs)
    stats = f.snapshots(runs.where(F.col(TS).isin(*pair)))
    modalities = lookups.all_modalities(f.groups())
    return delta.delta_report(stats, f.study(), modalities, *pair, networks=NETWORKS)


def earlier_snapshot_of_each(f: Frames) -> DataFrame:
    """Up to four earlier snapshots for every customer's first order, and for every snapshot itself."""
    orders = f.table("orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("moment"))
    asked = orders.select(F.col("o_custkey").cast("string").alias("asked"), F.col("moment").cast("timestamp_ntz"))
    own = f.runs().select(F.lit("snapshot").alias("asked"), F.col(TS).alias("moment"))
    return snapshots.earlier_snapshot_of_each(asked.unionByName(own), f.runs(), "moment", offsets=4)


def report_lines(f: Frames) -> DataFrame:
    """The message, made from the written comparison as the daily job does."""
    path = f.scratch(f"delta-{uuid4().hex[:12]}")
    tables.publish(report(f), path)
    stored = tables.read_table(f.spark, path)
    return delta.report_lines(stored, *snapshot_pair(f.runs()), networks=NETWORKS)


_LINE = f"""concat(name, ' - ', format('{{:,}}', delta_files), ' files (', {binary_size("delta_bytes")}, ') ', qualifier)"""

_TOKEN = """concat('<!date^', epoch({0})::bigint::varchar, '^{{date_short}} {{time}}|',
    strftime({0}, '%Y-%m-%d %H:%M:%S'), ' UTC>')"""

_STALLED = "delta_files = 0 OR delta_bytes = 0"

CHECKS = {
    "latest_snapshot": Check(
        lambda f: snapshots.latest_snapshot(f.runs()),
        sql("SELECT max(cut) AS statistics_timestamp FROM cuts", "cuts"),
    ),
    "nth_previous_snapshot": Check(
        lambda f: snapshots.earlier_snapshots(f.runs(), _latest(f), depth=3),
        sql(
            """SELECT (row_number() OVER (ORDER BY cut DESC) - 1)::int AS steps_back, cut AS statistics_timestamp
            FROM cuts WHERE cut < (SELECT max(cut) FROM cuts) ORDER BY cut DESC LIMIT 3""",
            "cuts",
        ),
    ),
    "earlier_snapshot_of_each": Check(
        earlier_snapshot_of_each,
        sql(
            """SELECT asked, moment, steps_back, cut AS earlier_snapshot
            FROM (SELECT o_custkey::varchar AS asked, min(o_orderdate)::timestamp AS moment FROM orders GROUP BY o_custkey
                  UNION ALL SELECT 'snapshot', cut FROM cuts) AS a
            CROSS JOIN (SELECT unnest([0, 1, 2, 3])::int AS steps_back)
            LEFT JOIN (SELECT cut, row_number() OVER (ORDER BY cut) AS n FROM cuts) AS r
            ON n = (SELECT count(*) FROM cuts AS c WHERE c.cut < moment) - steps_back""",
            "cuts",
        ),
    ),
    "stats_study_join": Check(
        stats_study_join,
        sql(
            """SELECT study_id, modality, is_protected, is_raw, statistics_timestamp, files_count,
            study_country, network_id FROM stats LEFT JOIN adp_study USING (study_id)""",
            "stats",
            "adp_study",
        ),
    ),
    "stats_subject_study_join": Check(
        stats_subject_study_join,
        sql(
            """SELECT network_id, study_id, subject_id, modality, is_protected, is_raw, statistics_timestamp,
            size_bytes FROM stats LEFT JOIN adp_subjects USING (study_id, subject_id)
            LEFT JOIN adp_study USING (study_id) WHERE network_id IS NOT NULL""",
            "stats",
            "adp_subjects",
            "adp_study",
        ),
    ),
    "is_true_filter": Check(
        is_true_filter,
        sql(
            """SELECT study_id, modality, statistics_timestamp, is_protected, is_raw FROM stats
            WHERE is_protected IS TRUE AND CASE WHEN modality <> 'mri' THEN is_raw END IS TRUE""",
            "stats",
        ),
    ),
    "trailing_window": Check(
        trailing_window,
        sql(
            """SELECT study_id, modality, is_protected, is_raw, statistics_timestamp, files_count FROM stats
            WHERE statistics_timestamp >= (SELECT max(cut) FROM cuts) - interval 365 day""",
            "stats",
        ),
    ),
    "flow_totals_all": Check(
        lambda f: flow.flow_totals_all(f.snapshots()),
        sql(
            f"""SELECT modality, statistics_timestamp, sum(files_count)::bigint AS files_count,
            sum(size_bytes)::bigint AS size_bytes, sum(size_bytes)::bigint / {MB} AS files_size_mb
            FROM stats WHERE {SCOPE} GROUP BY modality, statistics_timestamp""",
            "stats",
        ),
    ),
    "flow_totals": Check(
        totals,
        sql(f"SELECT *, size_bytes / {MB} AS files_size_mb FROM totals", "totals"),
    ),
    "flow_count_diff": Check(
        lambda f: diffs(f).select("network_id", "modality", TS, "files_count", "files_count_diff"),
        sql(
            "SELECT network_id, modality, statistics_timestamp, files_count, files_count_diff FROM diffs",
            "diffs",
        ),
    ),
    "flow_size_diff": Check(
        lambda f: diffs(f).select("network_id", "modality", TS, "files_size_mb", "files_size_mb_diff"),
        sql(
            "SELECT network_id, modality, statistics_timestamp, files_size_mb, files_size_mb_diff FROM diffs",
            "diffs",
        ),
    ),
    "flow_scale": Check(
        lambda f: flow.flow_scale(diffs(f)),
        sql(
            """SELECT network_id, modality, max(files_count_diff) AS max_files,
            max(files_size_mb_diff) AS max_size_mb, max(files_size_mb_diff) * 1.1::double AS size_axis_top,
            max(files_count_diff)::double * 0.05::double AS files_label_at,
            max(files_size_mb_diff) * 0.05::double AS size_label_at FROM diffs GROUP BY ALL""",
            "diffs",
        ),
    ),
    "flow_series": Check(
        flow_series,
        sql(
            f"""SELECT network_id, modality, moment AS statistics_timestamp, n::bigint AS files_count,
            b / {MB} AS files_size_mb, n - lag(n) OVER w AS files_count_diff,
            b - lag(b) OVER w AS size_bytes_diff, (b - lag(b) OVER w) / {MB} AS files_size_mb_diff,
            moment::date AS day, upper(modality) AS label, strftime(moment, '%b %d') AS day_label,
            CASE WHEN isodow(moment) = 6 THEN moment - interval 12 hour END AS band_start,
            CASE WHEN isodow(moment) = 6 THEN moment + interval 36 hour END AS band_end,
            CASE WHEN isodow(moment) = 6 THEN moment + interval 12 hour END AS band_label_at
            FROM (SELECT coalesce(network_id, 'AllNetworks') AS network_id, modality, statistics_timestamp AS moment,
                  sum(files_count)::bigint AS n, sum(size_bytes)::bigint AS b
                  FROM daily_stats JOIN adp_study USING (study_id)
                  WHERE statistics_timestamp >= (SELECT max(ts)::date FROM events) - interval 14 day
                  GROUP BY GROUPING SETS ((network_id, modality, statistics_timestamp),
                                          (modality, statistics_timestamp)))
            WINDOW w AS (PARTITION BY network_id, modality ORDER BY moment)""",
            "daily_stats",
            "adp_study",
        ),
    ),
    "weekend_bands": Check(
        weekend_bands,
        """SELECT DISTINCT ts::date AS snapshot_date, ts::date - interval 12 hour AS band_start,
        ts::date + interval 36 hour AS band_end, ts::date + interval 12 hour AS band_label_at
        FROM events WHERE isodow(ts) = 6""",
    ),
    "report_skeleton": Check(
        lambda f: delta.report_skeleton(lookups.all_modalities(f.groups()), NETWORKS),
        sql("SELECT * FROM skeleton", "skeleton"),
    ),
    "delta_files": Check(
        lambda f: report(f).select(
            "network_id", "modality", "files_now", "files_before", "delta_files", "current_missing"
        ),
        sql(
            "SELECT network_id, modality, files_now, files_before, delta_files, current_missing FROM delta",
            "delta",
        ),
    ),
    "delta_size": Check(
        lambda f: report(f).select(
            "network_id", "modality", "bytes_now", "bytes_before", "delta_bytes", "delta_size_mb", "is_stalled"
        ),
        sql(
            f"""SELECT network_id, modality, bytes_now, bytes_before, delta_bytes,
            delta_bytes / {MB} AS delta_size_mb, {_STALLED} AS is_stalled FROM delta""",
            "delta",
        ),
    ),
    "flow_alert": Check(
        lambda f: delta.flow_alert(report(f)),
        sql(
            f"""SELECT coalesce(bool_or({_STALLED}), false) AS issue_detected,
            (count(*) FILTER (WHERE {_STALLED}))::bigint AS stalled_rows FROM delta WHERE indent = 0""",
            "delta",
        ),
    ),
    "report_lines": Check(
        report_lines,
        sql(
            f"""SELECT 0 AS section, 0 AS network_order, '' AS modality_order, 0 AS sub_order, 'title' AS kind,
            0 AS indent, concat('Comparing ', {_TOKEN.format('latest')}, ' to ', {_TOKEN.format('previous')}, '.')
            AS text FROM moments
            UNION ALL SELECT DISTINCT 1, network_order, '', 0, 'network', 0, network_id FROM delta
            UNION ALL SELECT 1, network_order, parent, sub_order, 'bullet', indent, {_LINE} FROM delta
            UNION ALL SELECT 2, 0, '', 0, 'warning', 0, '*Potential Data-Flow issue detected!*' FROM moments
            WHERE EXISTS (SELECT 1 FROM delta WHERE indent = 0 AND ({_STALLED}))
            UNION ALL SELECT 3, 0, '', 0, 'info', 0, 'Only includes *PROTECTED* and *raw* files' FROM moments""",
            "delta",
        ),
    ),
}
