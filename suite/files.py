"""Checks over the file catalogue: names, paths, tags, statistics."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite.check import Check
from suite.frames import EVENT_CENTS, Frames
from suite.sql import sql
from tidegauge import schemas
from tidegauge.functions import paths, values
from tidegauge.operators import lookups, quality, statistics
from tidegauge.sinks import tables

PARTS = ["study_dir", "is_protected", "is_raw", "subject_id", "modality"]


def file_attributes(f: Frames) -> DataFrame:
    named = f.files().select("file_path", "size_bytes", paths.base_name("file_path").alias("file_name"))
    return named.select(
        "file_path",
        "file_name",
        paths.file_type("file_name").alias("file_type"),
        values.bytes_to_mb("size_bytes").alias("file_size_mb"),
        values.mb_to_bytes(values.bytes_to_mb("size_bytes")).alias("bytes_again"),
    )


def parsed_paths(f: Frames) -> DataFrame:
    parts = paths.path_parts("file_path")
    return f.files().select("file_path", *[parts[name].alias(name) for name in PARTS])


def file_tags(f: Frames) -> DataFrame:
    return f.catalog().select("file_path", "metadata")


def subject_files(f: Frames) -> DataFrame:
    """Every subject asks for the files of one modality, picked by its market segment."""
    requests = f.subjects().selectExpr(
        "study_id",
        "subject_id",
        """CASE note WHEN 'MACHINERY' THEN 'phone' WHEN 'BUILDING' THEN 'surveys' WHEN 'AUTOMOBILE' THEN 'mri'
        WHEN 'FURNITURE' THEN 'eeg' ELSE 'interviews' END AS modality""",
    )
    wanted = f.files().select("study_id", "subject_id", "modality", "file_path", "size_bytes")
    return lookups.files_for(wanted, requests.hint("merge"))


def catalog_files_join(f: Frames) -> DataFrame:
    """Placement and attributes, stored in buckets of the path, joined again on it.

    The files are shuffled by path once, without what follows from their path, and both tables are made
    of these buckets.
    """
    name, key = f"join-{uuid4().hex[:12]}", ["file_path"]
    buckets = f.file_buckets()
    both = f.scratch(f"{name}/both")
    tables.publish_clustered(f.files().drop("network_id", "k", "file_name"), both, key, buckets)
    placed = tables.read_clustered(f.spark, both).withColumn("file_name", paths.base_name("file_path"))
    for part, rows in (("catalog", f.catalog(placed)), ("files", f.file_sizes(placed))):
        tables.publish_clustered(rows, f.scratch(f"{name}/{part}"), key, buckets)
    tables.drop_clustered(f.spark, both)
    catalog, files = (
        tables.read_clustered(f.spark, f.scratch(f"{name}/{part}")) for part in ("catalog", "files")
    )
    return lookups.catalog_with_files(catalog, files.hint("merge")).select(
        "file_path", "study_id", "subject_id", "modality", "file_name", "size_bytes", "file_size_mb"
    )


def files_by_tag(f: Frames) -> DataFrame:
    """Files whose tag names MGB, and events whose property `k` contains a 7."""
    files = lookups.files_by_tag(f.catalog(), "redcap_instance", "MGB")
    events = lookups.files_by_tag(f.table("events"), "k", "7", metadata="props")
    return files.select(F.col("file_path").alias("found")).unionByName(
        events.select(F.col("event_id").cast("string").alias("found"))
    )


def subject_files_by_tag(f: Frames) -> DataFrame:
    """Every active subject asks the stored catalogue for its surveys from MGB."""
    requests = f.subjects().where("is_active").selectExpr("study_id", "subject_id", "'surveys' AS modality")
    catalog = tables.read_table(f.spark, f.stored_catalog(), schemas.CATALOG_WIDE)
    found = lookups.indexed_files_by_tag(
        catalog, f.groups(), requests.hint("merge"), "redcap_instance", "MGB"
    )
    return found.select("study_id", "subject_id", "file_path", "metadata")


def active_files_by_tag(f: Frames) -> DataFrame:
    """The same from the JSON text of a catalogue that has no tag columns."""
    requests = f.subjects().where("is_active").selectExpr("study_id", "subject_id", "'surveys' AS modality")
    found = lookups.files_for_by_tag(f.catalog(), requests.hint("merge"), "redcap_instance", "MGB")
    return found.select("study_id", "subject_id", "file_path", "metadata")


def volume_statistics(f: Frames) -> DataFrame:
    return statistics.volume_statistics(f.files(), f.tags())


def union_scopes(f: Frames) -> DataFrame:
    """Files and events as one stream of sized items."""
    files = f.files_base().select(F.lit("files").alias("origin"), "modality", "size_bytes")
    events = f.table("events").selectExpr(
        "'events' AS origin", f"{EVENT_CENTS} AS size_bytes", "event_type AS modality"
    )
    return statistics.union_results(files, events)


def pk_duplicates(f: Frames) -> DataFrame:
    """The short key of files repeats; the path does not."""
    short = quality.pk_duplicates(f.table("lineitem"), ["l_orderkey", "l_linenumber"])
    path = quality.pk_duplicates(f.files(), ["file_path"])
    return short.selectExpr(
        "concat_ws('-', cast(l_orderkey AS string), cast(l_linenumber AS string)) AS key", "rows"
    ).unionByName(path.selectExpr("file_path AS key", "rows"))


def run_counts(f: Frames) -> DataFrame:
    return statistics.run_counts(
        files=f.files_base(),
        subjects=f.subjects(),
        networks=f.study().select("network_id").distinct(),
    )


_BY_TAG = sql(
    """SELECT study_id, subject_id, file_path, concat('{"redcap_instance":"', tag, '"}') AS metadata
    FROM cat SEMI JOIN (SELECT * FROM adp_subjects WHERE is_active) USING (study_id, subject_id)
    WHERE tag LIKE 'MGB%' AND modality = 'surveys'""",
    "cat",
    "adp_subjects",
)

CHECKS = {
    "volume_statistics": Check(volume_statistics, sql("SELECT * FROM volumes", "volumes")),
    "subtype_statistics": Check(
        lambda f: statistics.volume_statistics(f.files(), f.tags(), main_rows=False),
        sql("SELECT * FROM volumes WHERE modality LIKE '%\\_%' ESCAPE '\\'", "volumes"),
    ),
    "summary_rollup": Check(
        lambda f: statistics.summary_rollup(f.files_base()),
        sql(
            """SELECT network_id, study_id, subject_id, modality,
            grouping(network_id, study_id, subject_id, modality)::int AS level, count(*) AS files_count,
            sum(size_bytes)::bigint AS size_bytes, sum(size_bytes)::bigint / 1048576.0::double AS files_size_mb
            FROM files_base GROUP BY ROLLUP (network_id, study_id, subject_id, modality)""",
            "files_base",
        ),
    ),
    "file_attributes": Check(
        file_attributes,
        sql(
            """SELECT file_path, file_name, CASE
            WHEN modality IN ('phone', 'surveys') THEN '.json' WHEN modality = 'mri' THEN '.zip'
            WHEN modality = 'eeg' THEN '.eeg' WHEN file_name LIKE '%.tar.gz' THEN '.gz'
            WHEN file_name LIKE '%.csv' THEN '.csv' ELSE '' END AS file_type,
            size_bytes / 1048576.0::double AS file_size_mb, size_bytes AS bytes_again FROM cat""",
            "cat",
        ),
    ),
    "path_parts": Check(
        parsed_paths,
        sql(f"SELECT file_path, {', '.join(PARTS)} FROM cat", "cat"),
    ),
    "modalities_from_paths": Check(
        lambda f: lookups.modalities_from_paths(parsed_paths(f)),
        sql(f"SELECT DISTINCT {', '.join(PARTS)} FROM cat", "cat"),
    ),
    "file_tags": Check(
        file_tags,
        sql(
            """SELECT file_path, CASE WHEN tag IS NULL THEN '{}'
            WHEN modality = 'phone' THEN concat('{"mindlamp_type":"', tag, '"}')
            ELSE concat('{"redcap_instance":"', tag, '"}') END AS metadata FROM cat""",
            "cat",
        ),
    ),
    "files_by_tag": Check(
        files_by_tag,
        sql(
            """SELECT file_path AS found FROM cat WHERE tag LIKE 'MGB%' AND modality = 'surveys'
            UNION ALL SELECT event_id::varchar FROM events WHERE props->>'$.k' LIKE '%7%'""",
            "cat",
        ),
    ),
    "subject_files_by_tag": Check(subject_files_by_tag, _BY_TAG),
    "active_files_by_tag": Check(active_files_by_tag, _BY_TAG),
    "subject_files": Check(
        subject_files,
        sql(
            """SELECT c.study_id, c.subject_id, c.modality, file_path, size_bytes
            FROM cat c JOIN adp_subjects s ON c.study_id = s.study_id AND c.subject_id = s.subject_id
            AND c.modality = CASE note WHEN 'MACHINERY' THEN 'phone' WHEN 'BUILDING' THEN 'surveys'
            WHEN 'AUTOMOBILE' THEN 'mri' WHEN 'FURNITURE' THEN 'eeg' ELSE 'interviews' END""",
            "cat",
            "adp_subjects",
        ),
    ),
    "catalog_files_join": Check(
        catalog_files_join,
        sql(
            """SELECT file_path, study_id, subject_id, modality, file_name, size_bytes,
            size_bytes / 1048576.0::double AS file_size_mb FROM cat""",
            "cat",
        ),
    ),
    "distinct_modalities": Check(
        lambda f: lookups.all_modalities(f.groups()),
        sql("SELECT DISTINCT modality FROM files_base", "files_base"),
    ),
    "subject_modalities": Check(
        lambda f: lookups.subject_modalities(f.groups()),
        sql("SELECT DISTINCT study_id, subject_id, modality FROM files_base", "files_base"),
    ),
    "flag_filter": Check(
        lambda f: statistics.flag_filter(f.files(), True, False).select("file_path", "modality"),
        sql("SELECT file_path, modality FROM cat WHERE is_protected AND NOT is_raw", "cat"),
    ),
    "union_scopes": Check(
        union_scopes,
        sql(
            """SELECT 'files' AS origin, modality, size_bytes FROM files_base
            UNION ALL SELECT 'events', event_type, cast(round(value * 100) AS bigint) FROM events""",
            "files_base",
        ),
    ),
    "pk_duplicates": Check(
        pk_duplicates,
        """SELECT concat_ws('-', l_orderkey::varchar, l_linenumber::varchar) AS key, count(*) AS rows
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    ),
    "run_counts": Check(
        run_counts,
        """SELECT 'files' AS what, count(*) AS found FROM lineitem
        UNION ALL SELECT 'subjects', count(*) FROM customer
        UNION ALL SELECT 'networks', count(DISTINCT n_regionkey) FROM nation""",
    ),
}
