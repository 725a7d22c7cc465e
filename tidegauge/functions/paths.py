"""File names and the directory layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge import rules
from tidegauge.functions import as_col
from tidegauge.functions.text import sentence_case

# Last suffix of a name; a leading dot alone does not start a suffix.
_SUFFIX = r"(?s)^.+(\.[^.]+)$"
# The suffix before a final ".lock", when the name has one.
_SUFFIX_BEFORE_LOCK = r"(?s)^\.*[^.].*(\.[^.]*)\.lock$"
# {tree}/{study dir}/{stage}/{subject}/{modality}/ somewhere in a path.
_LAYOUT = (
    f"/((?:{rules.PROTECTED_DIR}|{rules.GENERAL_DIR})/[^/]+/"
    f"(?:{rules.RAW_DIR}|{rules.PROCESSED_DIR})/[^/]+/[^/]+)/"
)


def base_name(path: str | Column) -> Column:
    return F.substring_index(as_col(path), "/", -1)


def file_type(name: str | Column) -> Column:
    """Last suffix, looking through `.lock`; empty when there is none."""
    name = as_col(name)
    return F.when(
        name.endswith(".lock"), F.regexp_extract(name, _SUFFIX_BEFORE_LOCK, 1)
    ).otherwise(F.regexp_extract(name, _SUFFIX, 1))


def study_dir(network: str | Column, study: str | Column) -> Column:
    """Directory name of a study: network in sentence case, then the study id."""
    return F.concat(sentence_case(network), as_col(study))


def metadata_file(network: str | Column, study: str | Column) -> Column:
    return F.concat(study_dir(network, study), F.lit(rules.METADATA_SUFFIX))


def tree_name(is_protected: str | Column) -> Column:
    return F.when(as_col(is_protected), rules.PROTECTED_DIR).otherwise(rules.GENERAL_DIR)


def stage_name(is_raw: str | Column) -> Column:
    return F.when(as_col(is_raw), rules.RAW_DIR).otherwise(rules.PROCESSED_DIR)


def subject_dir(
    root: str | Column,
    network: str | Column,
    study: str | Column,
    subject: str | Column,
    is_protected: str | Column,
    is_raw: str | Column,
) -> Column:
    return F.concat_ws(
        "/",
        as_col(root),
        tree_name(is_protected),
        study_dir(network, study),
        stage_name(is_raw),
        as_col(subject),
    )


def path_parts(path: str | Column) -> dict[str, Column]:
    """Flags, study directory, subject and modality read back from a file path.

    A path outside the layout, such as a file lying directly in a subject
    directory, gives null parts.
    """
    found = F.nullif(F.regexp_extract(as_col(path), _LAYOUT, 1), F.lit(""))
    parts = F.split(found, "/")
    return {
        "is_protected": parts[0] == rules.PROTECTED_DIR,
        "study_dir": parts[1],
        "is_raw": parts[2] == rules.RAW_DIR,
        "subject_id": parts[3],
        "modality": parts[4],
    }


def tag_columns(
    name: str | Column,
    modality: str | Column,
    is_protected: str | Column,
    is_raw: str | Column,
    tag_rules: tuple[rules.TagRule, ...] = rules.TAG_RULES,
) -> dict[str, Column]:
    """One nullable text column per tag key; only protected raw files carry tags."""
    name, modality = as_col(name), as_col(modality)
    eligible = as_col(is_protected) & as_col(is_raw) & name.endswith(rules.TAG_FILE_SUFFIX)

    def hit(rule: rules.TagRule) -> Column:
        text = name.endswith(rule.text) if rule.match == "suffix" else name.contains(rule.text)
        return eligible & (modality == rule.modality) & text

    tags: dict[str, Column] = {}
    for rule in tag_rules:
        chain = tags.get(rule.key, F)
        tags[rule.key] = chain.when(hit(rule), F.lit(rule.value))
    return tags


def tag_json(tags: dict[str, Column]) -> Column:
    """The tag map as JSON text; `{}` when nothing matched."""
    return F.to_json(F.struct(*[tags[k].alias(k) for k in sorted(tags)]))
