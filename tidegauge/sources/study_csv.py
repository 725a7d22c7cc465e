"""Study metadata: one CSV file per study, with a header that may differ per file."""

from __future__ import annotations

import csv
import io
import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge import rules
from tidegauge.functions.paths import metadata_file, study_dir
from tidegauge.functions.times import parse_date
from tidegauge.functions.values import missing_to_null, nonzero_flag, pack_map
from tidegauge.sources import csv_records
from tidegauge.sources.tree import check_mounted

_FILE_SCHEMA = "study_id string, pos int, path string, header array<string>, unread string"
# As much of a file as may be its header.
_HEADER_CHARS = 1 << 20
# Position of a row: its file, start of its split, then its number within the scan.
SEQUENCE = ["path", "block", "line"]


def candidate_files(study: DataFrame, roots: str) -> DataFrame:
    """Where the metadata file of each study would be, under each comma-separated root."""
    priority = [
        F.struct(F.lit(pos).alias("pos"), F.lit(root).alias("root"))
        for pos, root in enumerate(check_mounted(roots).split(","))
    ]
    path = F.concat_ws(
        "/",
        F.col("root"),
        F.lit(rules.PROTECTED_DIR),
        study_dir("network_id", "study_id"),
        metadata_file("network_id", "study_id"),
    )
    return study.select("study_id", "network_id", F.inline(F.array(*priority))).select(
        "study_id", "pos", path.alias("path")
    )


def _column_names(header: list[str]) -> list[str]:
    """Unique names in the manner of common CSV readers: blanks numbered, repeats suffixed."""
    seen: dict[str, int] = {}
    names = []
    for i, name in enumerate(header):
        name = name or f"Unnamed: {i}"
        repeat = seen.get(name, 0)
        seen[name] = repeat + 1
        names.append(f"{name}.{repeat}" if repeat else name)
    return names


def _header_of(path: str) -> tuple[list[str], str | None]:
    """The column names of a file, or what keeps them from being read."""
    try:
        with open(path, encoding="utf-8-sig", newline="") as file:
            start = file.read(_HEADER_CHARS)
        return _column_names(next(csv.reader(io.StringIO(start, newline="")), [])), None
    except UnicodeDecodeError:
        return [], csv_records.NOT_UTF8
    except OSError as error:
        return [], error.strerror or str(error)
    except csv.Error as error:
        return [], f"header: {error}"


def _files_at(path: str) -> list[str]:
    """The file, or the parts of a folder of parts in the order of their names."""
    if os.path.isdir(path):
        return sorted(f"{path}/{name}" for name in os.listdir(path) if name.startswith("part-"))
    return [path] if os.path.isfile(path) else []


def _read_headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for row in batch.itertuples():
            place = re.sub("/+", "/", row.path)
            try:
                paths = _files_at(place)
            except OSError as error:
                found.append((row.study_id, row.pos, place, [], error.strerror or str(error)))
                continue
            found += [(row.study_id, row.pos, path, *_header_of(path)) for path in paths]
        yield pd.DataFrame(found, columns=["study_id", "pos", "path", "header", "unread"])


def find_files(candidates: DataFrame) -> DataFrame:
    """The files of each study below the first root that has any, each with its own header.

    `problem` names what keeps a file from being read: an error of the file system, text that is
    not UTF-8, a required column that its header lacks. A study without a file is a row with a
    null path.
    """
    probed = candidates.repartition("path").mapInPandas(_read_headers, _FILE_SCHEMA)
    first = Window.partitionBy("study_id")
    found = probed.withColumn("first", F.min("pos").over(first)).where(F.col("pos") == F.col("first"))
    lacking = F.array_except(F.array(*[F.lit(f) for f in rules.REQUIRED_FIELDS]), "header")
    problem = (
        F.when(F.col("path").isNull(), F.lit("no metadata file"))
        .when(F.col("unread").isNotNull(), F.col("unread"))
        .when(F.size(lacking) > 0, F.concat(F.lit("missing column: "), F.array_join(lacking, ", ")))
    )
    studies = candidates.select("study_id").distinct()
    return (
        studies.join(found, "study_id", "left")
        .select("study_id", "path", "header", problem.alias("problem"))
    )


def read_lines(files: DataFrame) -> DataFrame:
    """Lines of all files that can be read; only their names come to the driver."""
    usable = files.where(F.col("problem").isNull()).select("path")
    paths = [row["path"] for row in usable.toLocalIterator()]
    if not paths:
        raise FileNotFoundError("no study metadata file that can be read")
    return csv_records.read_lines(files.sparkSession, paths)


def read_metadata(lines: DataFrame, report: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of all study files, with the study, the file and the position in it.

    `values` maps the header's names to cells, so names never meet those of the result:
    they may differ in case only, or be `study_id`. Rows shorter than the header lack the
    last cells; longer ones are marked `is_ragged` and keep their text in `raw`.

    Lines and their report are written tables. Files are split between tasks wherever Spark likes.
    """
    usable = files.where(F.col("problem").isNull())
    width = usable.agg(F.max(F.size("header"))).first()[0]
    names = [f"c{i}" for i in range(width)]
    kind = T.StructType([T.StructField(name, T.StringType()) for name in names])
    records = csv_records.read_records(lines, report)
    rows = records.join(usable.select("path", "study_id", "header"), "path")
    row = F.from_csv("text", F.lit(kind.simpleString()), {"escape": '"'})
    cells = F.slice(F.array(*[F.col("row")[name] for name in names]), 1, F.size("header"))
    return rows.withColumn("row", row).select(
        "study_id",
        *SEQUENCE,
        F.map_from_arrays("header", cells).alias("values"),
        F.col("text").alias("raw"),
        (csv_records.field_count(F.col("text")) > F.size("header")).alias("is_ragged"),
    )


def parse_rows(rows: DataFrame, number_notes: dict[str, str] | None = None) -> DataFrame:
    """Subjects as far as they can be parsed; `problem` tells why a row is not one.

    Rows lacking a required field are dropped, as they name no subject. More fields than the
    header, a flag that is no number or a date that is no date are problems. Every further
    column that has a value goes into the JSON notes, as a number where `number_notes`
    gives its type.
    """
    texts = [missing_to_null(F.col("values")[name]) for name in rules.REQUIRED_FIELDS]
    complete = rows.where(F.col("is_ragged") | ~F.greatest(*[text.isNull() for text in texts]))
    others = F.map_filter(
        "values",
        lambda name, text: ~name.isin(*rules.REQUIRED_FIELDS) & missing_to_null(text).isNotNull(),
    )
    parsed = complete.select(
        "study_id",
        F.col("values")["Subject ID"].alias("subject_id"),
        nonzero_flag(F.col("values")["Active"]).alias("is_active"),
        parse_date(F.col("values")["Consent"]).alias("consent_date"),
        pack_map(others, number_notes).alias("optional_notes"),
        F.col("values")["Active"].alias("active_text"),
        F.col("values")["Consent"].alias("consent_text"),
        "raw",
        "is_ragged",
        *SEQUENCE,
    )
    problem = (
        F.when(F.col("is_ragged"), F.lit("more fields than the header"))
        .when(F.col("is_active").isNull(), F.lit("flag is no number"))
        .when(F.col("consent_date").isNull(), F.lit("date is no date"))
    )
    return parsed.withColumn("problem", problem)


def subject_rows(
    rows: DataFrame, number_notes: dict[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Subjects, and the rows in quarantine."""
    return split_rows(parse_rows(rows, number_notes))


def split_rows(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed rows without a problem, and those in quarantine."""
    subjects = parsed.where(F.col("problem").isNull()).select(
        "study_id", "subject_id", "is_active", "consent_date", "optional_notes", *SEQUENCE
    )
    ragged_text = F.when(F.col("is_ragged"), F.col("raw")).alias("row_text")
    quarantine = parsed.where(F.col("problem").isNotNull()).select(
        "study_id", "subject_id", "active_text", "consent_text", "optional_notes", "path", "problem", ragged_text
    )
    return subjects, quarantine
