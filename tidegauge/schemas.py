"""Table schemas, primary keys and foreign keys."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _B, _L, _D = T.StringType(), T.BooleanType(), T.LongType(), T.DoubleType()
_TS = T.TimestampNTZType()


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


NETWORKS = _schema(("network_id", _S, False))

STUDY = _schema(
    ("study_id", _S, False),
    ("study_name", _S, False),
    ("study_country", _S, True),
    ("study_country_code", _S, True),
    ("network_id", _S, False),
)

SUBJECTS = _schema(
    ("study_id", _S, False),
    ("subject_id", _S, False),
    ("is_active", _B, False),
    ("consent_date", T.DateType(), False),
    ("optional_notes", _S, True),
)

FILES = _schema(
    ("file_name", _S, False),
    ("file_type", _S, False),
    ("file_size_mb", _D, False),
    ("file_path", _S, False),
    ("m_time", _TS, False),
    ("md5", _S, True),
    ("size_bytes", _L, False),
)

FILE_CATALOG = _schema(
    ("study_id", _S, False),
    ("subject_id", _S, False),
    ("file_path", _S, False),
    ("is_raw", _B, False),
    ("is_protected", _B, False),
    ("modality", _S, False),
    ("extracted_timestamp", _TS, True),
    ("metadata", _S, True),
)

# One crawl fills `files` and `file_catalog` from the same rows, so they are
# stored as one wide table and the two narrow ones are projections of it. No
# job then needs a join on the path of every file.
# Tags stand there as JSON and as columns, by which row groups can be skipped.
TAGS = _schema(("mindlamp_type", _S, True), ("redcap_instance", _S, True))
CATALOG_WIDE = T.StructType(
    FILE_CATALOG.fields + TAGS.fields + [f for f in FILES.fields if f.name != "file_path"]
)

VOLUME_STATISTICS = _schema(
    ("study_id", _S, False),
    ("subject_id", _S, False),
    ("is_raw", _B, False),
    ("is_protected", _B, False),
    ("modality", _S, False),
    ("files_count", _L, False),
    ("files_size_mb", _D, False),
    ("size_bytes", _L, False),
    ("statistics_timestamp", _TS, True),
    ("snapshot_date", T.DateType(), True),
    ("run_id", _S, True),
)

LOGS = _schema(
    ("log_id", _S, False),
    ("log_module", _S, False),
    ("log_message", _S, False),
    ("log_timestamp", _TS, True),
)

TABLES = {
    "logs": LOGS,
    "networks": NETWORKS,
    "study": STUDY,
    "subjects": SUBJECTS,
    "file_catalog": CATALOG_WIDE,
    "volume_statistics": VOLUME_STATISTICS,
}

PRIMARY_KEYS = {
    "logs": ["log_id"],
    "networks": ["network_id"],
    "study": ["study_id"],
    "subjects": ["study_id", "subject_id"],
    "files": ["file_path"],
    "file_catalog": ["file_path"],
    "volume_statistics": [
        "study_id",
        "subject_id",
        "is_raw",
        "is_protected",
        "modality",
        "statistics_timestamp",
    ],
}

# Order of the stored catalogue: lookups go by subject and modality.
CATALOG_ORDER = ["study_id", "subject_id", "modality", "file_path"]

# Equality lookups by path, tag or subject skip row groups by these filters.
CATALOG_OPTIONS = {
    f"parquet.bloom.filter.enabled#{column}": "true"
    for column in ("file_path", "subject_id", *TAGS.names)
}

# child table -> [(columns, parent table)]; the wide catalogue holds the attributes of its files itself
FOREIGN_KEYS = {
    "study": [(["network_id"], "networks")],
    "subjects": [(["study_id"], "study")],
    "file_catalog": [(["study_id", "subject_id"], "subjects")],
    "volume_statistics": [(["study_id", "subject_id"], "subjects")],
}
