"""Stored tables: whole versions, buckets of a key, snapshots by run.

`publish` fills a new version of a table and marks it last; tables of parts (`parts.py`) write their
index last. So readers see the old table or the new one. Rules on keys are checked in the tasks
that fill a version: one that breaks them stays invisible. Only `append` of `write_table`
adds to the visible version: read it after the job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime
from itertools import chain
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge import schemas
from tidegauge.functions.values import bytes_to_mb
from tidegauge.operators.snapshots import DAY, TS, ntz
from tidegauge.operators.upsert import insert_conflicts, upsert
from tidegauge.session import shuffles_released
from tidegauge.sinks import parts, versions
from tidegauge.sinks.versions import KeyViolation, Rules

__all__ = ["KeyViolation", "Rules"]

SNAPSHOT_PARTITIONS = ["snapshot_date", "run_id"]
# Attempts with this mark hold a history, whose rows hold for several runs; where the second one follows,
# `files_size_mb` is not stored but made of `size_bytes`.
_HISTORY, _NO_MB = "h", "s"
RUNS = parts.index_schema("snapshot_date date, run_id string", f"{TS} timestamp_ntz")
BUCKETS = parts.index_schema("bucket int", "buckets int")
# Counts kept beside the catalogue.
GROUPS = parts.Sums(["study_id", "subject_id", "modality", *schemas.TAGS.names])


def exists(spark: SparkSession, path: str) -> bool:
    return parts.exists(spark, path) or bool(versions.versions(spark, path))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The visible rows of a table of either kind; an empty table of the schema when there is none."""
    if not parts.exists(spark, path):
        return versions.read_version(spark, path, schema)
    if TS in parts.read_index(spark, path).columns:
        return read_snapshots(spark, path).select(*(schema or schemas.VOLUME_STATISTICS).names)
    if schema is None:
        first = parts.read_index(spark, path).select("folder").first()
        if first is None:
            raise FileNotFoundError(path)
        schema = spark.read.parquet(f"{path}/data/{first[0]}").schema
    return parts.read_parts(spark, path, schema)


def publish(
    rows: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    order_by: list[str] | None = None,
    rules: Rules | None = None,
    totals: Mapping[str, Column] | None = None,
) -> int:
    """Replace the whole table by a new version; returns its number.

    With `order_by` the files hold consecutive ranges, so that a lookup on leading
    columns skips most of them. End the list with a unique column: a range is then
    never stuck on one frequent value. Rows that break `rules` raise `KeyViolation`.
    """
    return publish_counted(rows, path, partition_by, order_by, rules, totals)[0]


def publish_counted(
    rows: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    order_by: list[str] | None = None,
    rules: Rules | None = None,
    totals: Mapping[str, Column] | None = None,
) -> tuple[int, dict[str, int]]:
    """As `publish`; returns also the number of `rows` and the `totals`, taken as they are written."""
    spark = rows.sparkSession
    version, folder = versions.next_folder(spark, path)
    if order_by:
        rows = rows.repartitionByRange(*order_by)
    found = versions.fill(rows, folder, rules, partition_by, order_by, totals)
    versions.mark(spark, folder)
    return version, found


def write_table(rows: DataFrame, path: str, if_exists: str = "replace") -> None:
    """`fail`, `replace` or `append` when the table exists; create it otherwise."""
    if if_exists not in ("fail", "replace", "append"):
        raise ValueError(f"if_exists must be fail, replace or append, not {if_exists!r}")
    spark = rows.sparkSession
    found = versions.versions(spark, path)
    if found and if_exists == "fail":
        raise FileExistsError(path)
    if found and if_exists == "append":
        rows.write.mode("append").parquet(versions.folder(path, found[-1]))
    else:
        publish(rows, path)


def upsert_table(
    new: DataFrame,
    path: str,
    key: list[str],
    schema: T.StructType,
    order_by: list[str] | None = None,
    parents: Mapping[tuple[str, ...], DataFrame] | None = None,
) -> tuple[int, dict[str, int]]:
    """Publish existing rows and new ones, the new replacing equal keys.

    For tables of moderate size, which are written anew; `upsert_buckets` is for large ones.
    """
    existing = read_table(new.sparkSession, path, schema)
    merged = upsert(existing, new.select(*schema.names), key)
    return publish_counted(merged, path, order_by=order_by, rules=Rules(key, parents))


def upsert_buckets(
    new: DataFrame | Sequence[DataFrame],
    path: str,
    key: list[str],
    schema: T.StructType,
    buckets: int,
    replace: bool = False,
    **more,
) -> dict[str, int]:
    """Merge new rows into a table stored in buckets of its key, or replace it.

    See `parts.write_buckets`: what no new key falls into is neither read nor written.
    """
    return parts.write_buckets(new, path, key, schema, buckets, replace, **more)


def check_new(new: DataFrame, path: str, key: list[str], schema: T.StructType) -> None:
    """Raise when a key is in the table already or given twice."""
    clash = insert_conflicts(read_table(new.sparkSession, path, schema), new, key).take(5)
    if clash:
        raise ValueError(f"duplicate keys for {path}, for example {[r.asDict() for r in clash]}")


def step(rows: DataFrame | Iterable[DataFrame], path: str) -> DataFrame:
    """Rows, or slices of them, written to a folder and read back, for a table between two shuffles;
    `versions.delete` it after use."""
    return versions.fill_all(rows, path, options={"compression": "zstd"})[0]


def insert_table(new: DataFrame, path: str, key: list[str], schema: T.StructType) -> None:
    """Append rows whose keys must all be new."""
    check_new(new, path, key, schema)
    write_table(new.select(*schema.names), path, "append")


def with_run(stats: DataFrame, run_ts: datetime) -> DataFrame:
    """Stamp a run's time on its statistics, in the column and as partition."""
    return stats.withColumns(
        {
            "statistics_timestamp": ntz(run_ts),
            "snapshot_date": F.lit(run_ts.date()),
            "run_id": F.lit(run_ts.strftime("%Y%m%dT%H%M%S%f")),
        }
    )


def append_snapshots(stats: DataFrame, path: str, many_runs: bool = False) -> dict[str, int]:
    """Add stamped snapshots; one that is there already is replaced, all others stay.

    A part is the day and the run; a run is seen from the moment its row stands in the index of
    runs, which is written last. A repeated run is filled beside the old one and takes its place.
    Readers choose runs by day, so a row whose day is not that of its time is an error. One run is
    written as it comes out of its aggregation; `many_runs` are first gathered by run, which
    needs a shuffle. Returns the number of rows and of counted files.
    """
    day = F.col(DAY)
    wrong = F.raise_error(F.lit("snapshot_date is not the day of statistics_timestamp"))
    same = day == F.col(TS).cast("date")
    stats = stats.withColumn(DAY, F.when(same, day).otherwise(wrong))
    if many_runs:
        stats = stats.hint("rebalance", *SNAPSHOT_PARTITIONS)
    totals = {"files": F.sum("files_count")}
    entries, found = parts.fill_parts(
        stats, path, SNAPSHOT_PARTITIONS, totals=totals, notes={TS: F.max(TS)}
    )
    parts.publish_index(entries, path, SNAPSHOT_PARTITIONS)
    return found


def append_history(
    recounts: DataFrame | Iterable[DataFrame], path: str, every: str, run_ids: str = "yyyyMMdd'T'HHmmssSSSSSS"
) -> dict[str, int]:
    """Add the snapshots of many runs at once, storing what stays from run to run only once.

    A recount holds at each `every` from the time `since` to its own time, both included; all rows
    count their steps from a common start. It is stored with the last run that it holds for, so
    the newest runs need the newest folders only; readers carry it back to the earlier ones. All runs
    that some recount holds for stand in the index. `files_size_mb` follows from `size_bytes` where it is not
    given, and is then made by the readers. The last run may hold most rows: `recounts` may come in slices of
    the same columns, of which one is shuffled at a time. Returns the number of stored rows and their files.
    """
    time = F.col(TS)
    # What follows from other columns is made behind the shuffle.
    follows = {DAY: time.cast("date"), "run_id": F.date_format(time, run_ids)}
    slices = iter([recounts] if isinstance(recounts, DataFrame) else recounts)
    first = next(slices)
    rows = (own.hint("rebalance", TS).withColumns(follows) for own in chain([first], slices))
    order = [*SNAPSHOT_PARTITIONS, "study_id", "subject_id", "modality"]
    mark = _HISTORY if "files_size_mb" in first.columns else _HISTORY + _NO_MB
    attempt = f"attempt={mark}{uuid4().hex}"
    written, found = parts.fill_attempt(
        rows,
        path,
        attempt,
        SNAPSHOT_PARTITIONS,
        order_by=order,
        totals={"files": F.sum("files_count")},
        options={"compression": "zstd"},
    )
    spans = written.groupBy("since", TS).agg(F.count(F.lit(1)).alias("rows"))
    at = F.explode(F.sequence("since", TS, F.expr(f"interval {every}"))).alias(TS)
    runs = spans.select(at, "rows").groupBy(TS).agg(F.sum("rows").alias("rows"))
    day, run = time.cast("date"), F.date_format(time, run_ids)
    entries = runs.select(
        day.alias(DAY),
        run.alias("run_id"),
        F.concat(F.lit(f"{attempt}/{DAY}="), day.cast("string"), F.lit("/run_id="), run).alias("folder"),
        "rows",
        F.lit(None).cast("string").alias("sums"),
        TS,
    )
    parts.publish_index(entries, path, SNAPSHOT_PARTITIONS)
    return found


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """One row for each visible snapshot, with its day, time and number of rows."""
    if not parts.exists(spark, path):
        return spark.createDataFrame([], RUNS)
    return parts.read_index(spark, path)


def read_snapshots(spark: SparkSession, path: str, runs: DataFrame | None = None) -> DataFrame:
    """Statistics of the given runs, of all visible ones by default; no other folder is looked at."""
    if runs is None:
        runs = read_runs(spark, path)
    in_history = F.col("folder").startswith(f"attempt={_HISTORY}")
    found = runs.select("folder", TS, *SNAPSHOT_PARTITIONS, in_history.alias("shared")).toArrow()
    attempts = [row["folder"].split("/")[0] if row["shared"] else "" for row in found.to_pylist()]
    rows = None
    if "" in attempts or not attempts:
        rows = parts.read_parts(spark, path, schemas.VOLUME_STATISTICS, runs.where(~in_history))
    for name in sorted(set(attempts) - {""}):
        held = found.filter(pa.array([a == name for a in attempts])).drop_columns(["folder", "shared"])
        own = _read_history(spark, path, name, held)
        rows = own if rows is None else rows.unionByName(own)
    return rows


def _read_history(spark: SparkSession, path: str, attempt: str, held: pa.Table) -> DataFrame:
    """Recounts of some runs of one history, each row once for every run that it holds for.

    A run's rows stand in its own folder and in those of later runs of its history.
    """
    wanted = schemas.VOLUME_STATISTICS
    schema = T.StructType([*wanted.fields, T.StructField("since", T.TimestampNTZType())])
    first = min(held[DAY].to_pylist())
    start = f"{attempt}/{DAY}={first}"
    folders = [f for f in parts.folders_of(spark, path, attempt, SNAPSHOT_PARTITIONS) if f >= start]
    stored = parts.read_folders(spark, path, schema, folders).where(F.col(DAY) >= F.lit(first))
    if attempt.startswith(f"attempt={_HISTORY}{_NO_MB}"):
        stored = stored.withColumn("files_size_mb", bytes_to_mb("size_bytes"))
    stored = stored.withColumnRenamed(TS, "_last").drop(*SNAPSHOT_PARTITIONS)
    # One short row a run, which Spark broadcasts.
    own = T.StructType([wanted[name] for name in (TS, *SNAPSHOT_PARTITIONS)])
    runs = spark.createDataFrame(held, own)
    holds = (F.col(TS) >= F.col("since")) & (F.col(TS) <= F.col("_last"))
    return stored.join(runs, holds).select(*wanted.names)


def read_slices(spark: SparkSession, path: str, schema: T.StructType, slices: int) -> list[DataFrame]:
    """The rows of a table in buckets, in so many slices of its buckets."""
    index = parts.read_index(spark, path)
    return [
        parts.read_parts(spark, path, schema, index.where(F.pmod(parts.BUCKET, F.lit(slices)) == number))
        for number in range(slices)
    ]


def read_groups(spark: SparkSession, path: str) -> DataFrame:
    """Files of the stored catalogue by study, subject, modality and tags, from the counts beside it."""
    return GROUPS.read(spark, path, schemas.CATALOG_WIDE)


def publish_clustered(rows: DataFrame, path: str, key: list[str], buckets: int) -> None:
    """Replace a table by a new version that is clustered and sorted by a key.

    Tables with the same number of buckets of the same key are joined on it without a shuffle. Spark
    knows of buckets through its catalogue only, so a version is an external table there; what
    it is clustered by stands in the table `layout`, which is written last.
    """
    spark = rows.sparkSession
    folder = versions.next_folder(spark, path)[1]
    clustered = rows.repartition(buckets, *key)
    with shuffles_released(spark):
        clustered.write.bucketBy(buckets, *key).sortBy(*key).option("path", folder).option(
            "compression", "zstd"
        ).format("parquet").saveAsTable(_clustered_name(folder))
    layout = spark.createDataFrame([(folder, key, buckets)], _LAYOUT)
    publish(layout, f"{path}/layout")


def read_clustered(spark: SparkSession, path: str) -> DataFrame:
    """The newest clustered version, made known to Spark's catalogue where it is not yet."""
    row = versions.read_version(spark, f"{path}/layout").first()
    name = _clustered_name(row["folder"])
    if not spark.catalog.tableExists(name):
        by = ", ".join(f"`{column}`" for column in row["key"])
        columns = spark.read.parquet(row["folder"]).schema
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns.toDDL()}) USING parquet CLUSTERED BY ({by}) "
            f"SORTED BY ({by}) INTO {row['buckets']} BUCKETS LOCATION '{row['folder']}'"
        )
    return spark.table(name)


def drop_clustered(spark: SparkSession, path: str) -> None:
    """Delete a clustered table with all its versions, for tables that are only a step."""
    for number in versions.versions(spark, path, marked=False):
        spark.sql(f"DROP TABLE IF EXISTS {_clustered_name(versions.folder(path, number))}")
    versions.delete(spark, path)


_LAYOUT = "folder string, key array<string>, buckets int"


def _clustered_name(folder: str) -> str:
    return f"tidegauge_{hashlib.sha256(folder.encode()).hexdigest()[:24]}"


def recreate_tables(spark: SparkSession, base: str) -> None:
    """Publish an empty version of every table, parents before children."""
    indexes = {"volume_statistics": RUNS, "file_catalog": BUCKETS}
    for name, schema in schemas.TABLES.items():
        if name in indexes:
            parts.publish_index(
                spark.createDataFrame([], indexes[name]), f"{base}/{name}", [], replace=True
            )
        else:
            publish(spark.createDataFrame([], schema), f"{base}/{name}")


def append_log(messages: DataFrame, path: str, module: str, run_ts: datetime) -> None:
    """Add `message` rows to the job log.

    Ids follow from the content and, for equal messages of a run, their number: all of them are
    kept, and a retry adds nothing.
    """
    stamped = messages.select(
        F.lit(module).alias("log_module"),
        F.col("message").alias("log_message"),
        ntz(run_ts).alias("log_timestamp"),
    )
    equal = Window.partitionBy("log_message").orderBy("log_module")
    stamped = stamped.withColumn("number", F.row_number().over(equal).cast("string"))
    text = F.concat_ws(
        "\n", "log_module", "log_message", F.col("log_timestamp").cast("string"), "number"
    )
    rows = stamped.withColumn("log_id", F.md5(text)).select(*schemas.LOGS.names)
    known = read_table(messages.sparkSession, path, schemas.LOGS).select("log_id")
    write_table(rows.join(known, "log_id", "left_anti"), path, "append")
