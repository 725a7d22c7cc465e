"""Dimension and catalogue lookups, in set form and for one key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.values import tag_contains


def list_studies(study: DataFrame) -> DataFrame:
    return study.select("study_id").orderBy("study_id")


def study_network(study: DataFrame, study_id: str | None = None) -> DataFrame:
    found = study.select("study_id", "network_id")
    return found if study_id is None else found.where(F.col("study_id") == study_id)


def list_subjects(subjects: DataFrame, study_id: str | None = None) -> DataFrame:
    found = subjects if study_id is None else subjects.where(F.col("study_id") == study_id)
    return found.select("study_id", "subject_id").orderBy("subject_id", "study_id")


def subject_study(subjects: DataFrame, subject_id: str | None = None) -> DataFrame:
    """Studies of a subject; a subject id may occur in several studies."""
    found = subjects.select("subject_id", "study_id")
    return found if subject_id is None else found.where(F.col("subject_id") == subject_id)


def all_modalities(catalog: DataFrame) -> DataFrame:
    return catalog.select("modality").distinct()


def subject_modalities(
    catalog: DataFrame, study_id: str | None = None, subject_id: str | None = None
) -> DataFrame:
    if study_id is not None:
        catalog = catalog.where(F.col("study_id") == study_id)
    if subject_id is not None:
        catalog = catalog.where(F.col("subject_id") == subject_id)
    return catalog.select("study_id", "subject_id", "modality").distinct()


def modalities_from_paths(paths: DataFrame) -> DataFrame:
    """Modalities of each subject directory, from rows of parsed path parts."""
    return (
        paths.where(F.col("modality").isNotNull())
        .select("study_dir", "is_protected", "is_raw", "subject_id", "modality")
        .distinct()
    )


def catalog_with_files(catalog: DataFrame, files: DataFrame) -> DataFrame:
    """Catalogue rows with their file attributes; both sides are unique on the path."""
    return catalog.join(files, "file_path", "left")


def files_for(catalog: DataFrame, requests: DataFrame) -> DataFrame:
    """Catalogue rows for every requested (study, subject, modality).

    Requests are unique on the three columns, so a subject with very many files
    only makes the catalogue side large, which the skew join splits.
    """
    return catalog.join(requests, ["study_id", "subject_id", "modality"])


def subject_files(
    catalog: DataFrame, study_id: str, subject_id: str, modality: str
) -> DataFrame:
    return catalog.where(
        (F.col("study_id") == study_id)
        & (F.col("subject_id") == subject_id)
        & (F.col("modality") == modality)
    )


def files_by_tag(
    rows: DataFrame, key: str, value: str, metadata: str = "metadata"
) -> DataFrame:
    """Rows whose JSON tag `key` contains `value`; a missing key never matches."""
    return rows.where(tag_contains(metadata, key, value))


# Most tag values that a filter names one by one; with more of them the text itself is tested.
_VALUES = 1000


def tag_filter(groups: DataFrame, key: str, value: str) -> Column:
    """A filter on the tag column `key` for tags that contain `value`.

    The values that a tag has stand in the counts beside the catalogue. Those that match are
    named in the filter, so that the scan skips row groups whose statistics, dictionary or Bloom
    filter have none of them.
    """
    found = groups.where(F.col(key).contains(value)).select(key).distinct().limit(_VALUES + 1)
    values = sorted(row[0] for row in found.collect())
    return F.col(key).contains(value) if len(values) > _VALUES else F.col(key).isin(*values)


def indexed_files_by_tag(
    catalog: DataFrame, groups: DataFrame, requests: DataFrame, key: str, value: str
) -> DataFrame:
    """Files of the requested (study, subject, modality) whose tag `key` contains `value`.

    `groups` counts the catalogue's files by these columns and tags: requests without such a file are
    dropped before the catalogue is read.
    """
    place = ["study_id", "subject_id", "modality"]
    tagged = tag_filter(groups, key, value)
    hits = requests.join(groups.where(tagged).select(*place).distinct(), place, "left_semi")
    return files_for(catalog.where(tagged), hits)


def files_for_by_tag(
    catalog: DataFrame, requests: DataFrame, key: str, value: str
) -> DataFrame:
    """Files of the requested (study, subject, modality) whose tag `key` contains `value`.

    Tags are tested first, so only matching files travel to the join.
    """
    return files_for(files_by_tag(catalog, key, value), requests)
