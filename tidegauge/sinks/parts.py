"""Tables made of parts that an index names.

A part is a folder with the rows of one value of the part columns: a run of the statistics, or a
bucket of a key. New parts are filled in folders of their own, below `data/attempt=…`; the index, a
small versioned table below `index/`, is written last and says which folder holds each part. A write
is therefore seen whole or not at all, parts that did not change keep their files, and a
folder that the index does not name, of a failed or repeated write, is never read. What
stands in the index, such as the time of a run, is known without opening a data file.

One writer at a time: of two that finish at once, the second one fails.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.session import shuffles_released
from tidegauge.sinks import versions
from tidegauge.sinks.versions import Rules

BUCKET = "bucket"
_PACKED = {"compression": "zstd"}
_ENTRY = "folder string, rows bigint, sums string"


def exists(spark: SparkSession, path: str) -> bool:
    return bool(versions.versions(spark, f"{path}/index"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row a part: the part columns, its `folder` below `data`, `rows`, the name of the table's
    `sums`, and what else was noted."""
    return versions.read_version(spark, f"{path}/index")


def index_schema(by: str, notes: str) -> str:
    return f"{by}, {_ENTRY}, {notes}"


def read_parts(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    chosen: DataFrame | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Rows of the chosen parts, of all by default; `columns` are part columns to keep beside the schema.

    Only folder names of the chosen parts come to the driver, and only these folders are listed.
    """
    index = read_index(spark, path) if chosen is None else chosen
    folders = sorted(row["folder"] for row in index.select("folder").collect())
    parts = [f for f in index.schema.fields if f.name not in schema.names and f.name in (columns or [])]
    return read_folders(spark, path, T.StructType([*schema.fields, *parts]), folders).select(
        *schema.names, *(columns or [])
    )


def read_folders(
    spark: SparkSession, path: str, schema: T.StructType, folders: list[str]
) -> DataFrame:
    """Rows below some folders of `data`, with the columns of the schema."""
    if not folders:
        return spark.createDataFrame([], schema)
    full = T.StructType([*schema.fields, T.StructField("attempt", T.StringType())])
    reader = spark.read.schema(full).option("basePath", f"{path}/data")
    return reader.parquet(*[f"{path}/data/{folder}" for folder in folders]).select(*schema.names)


def folders_of(spark: SparkSession, path: str, attempt: str, by: list[str]) -> list[str]:
    """The folders of parts that one attempt filled, below `data`, whether an index names them or not."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    below = hadoop.Path("/".join([f"{path}/data", attempt, *[f"{column}=*" for column in by]]))
    found = below.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(below)
    names = [status.getPath().toString() for status in found or []]
    return sorted(name[name.rindex(f"/{attempt}/") + 1 :] for name in names)


def fill_parts(
    rows: DataFrame | Iterable[DataFrame],
    path: str,
    by: list[str],
    rules: Rules | None = None,
    order_by: list[str] | None = None,
    totals: Mapping[str, Column] | None = None,
    notes: Mapping[str, Column] | None = None,
    options: Mapping[str, str] | None = None,
    attempt: str | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """Write rows as new parts that no index names yet; returns their entries and the observed totals.

    Entries come from the footers of the new files and the columns that `notes` sum up; of the notes of
    several files, the largest counts. They are as few as the parts, and made only once.
    """
    attempt = attempt or f"attempt=a{uuid4().hex}"
    written, found = fill_attempt(rows, path, attempt, by, rules, order_by, totals, options)
    # By file first, so that no aggregate has a text to compare, for which Spark would sort all rows.
    files = written.groupBy(*by, F.col("_metadata.file_path").alias("_file")).agg(
        F.count(F.lit(1)).alias("rows"),
        *[value.alias(name) for name, value in (notes or {}).items()],
    )
    place = F.regexp_extract(F.url_decode("_file"), f"{attempt}/(.*)/[^/]*$", 1)
    entries = files.groupBy(*by).agg(
        F.concat(F.lit(f"{attempt}/"), F.min(place)).alias("folder"),
        F.sum("rows").alias("rows"),
        F.lit(None).cast("string").alias("sums"),
        *[F.max(name).alias(name) for name in notes or {}],
    )
    return written.sparkSession.createDataFrame(entries.toArrow(), entries.schema), found


def fill_attempt(
    rows: DataFrame | Iterable[DataFrame],
    path: str,
    attempt: str,
    by: list[str],
    rules: Rules | None = None,
    order_by: list[str] | None = None,
    totals: Mapping[str, Column] | None = None,
    options: Mapping[str, str] | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """Write rows, or slices of them, into new folders below that of an attempt; returns the rows as stored
    and the totals. No two slices may hold rows of one part together that `rules` compare."""
    return versions.fill_all(rows, f"{path}/data/{attempt}", rules, by, order_by, totals, options)


def publish_index(
    entries: DataFrame, path: str, by: list[str], replace: bool = False, sums: str | None = None
) -> None:
    """Let readers see new parts: they replace those of the same part columns, or all parts.

    `sums` names the folder of the sums that hold from now on.
    """
    spark = entries.sparkSession
    if exists(spark, path) and not replace:
        old = read_index(spark, path)
        entries = old.join(entries.select(*by), by, "left_anti").unionByName(entries)
    if sums is not None:
        entries = entries.withColumn("sums", F.lit(sums))
    folder = versions.next_folder(spark, f"{path}/index")[1]
    entries.coalesce(1).write.parquet(folder)


# --- buckets of a key -------------------------------------------------------
def bucket_of(key: list[str], buckets: int) -> Column:
    """The bucket of a key: equal keys meet, and no frequent value of another column fills one."""
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def buckets_for(rows: int, rows_a_bucket: int = 400_000) -> int:
    """Enough buckets that a task can sort the rows of one in memory, twice at a time, by key and by order."""
    return max(8, -(-rows // rows_a_bucket))


def _placed(
    new: DataFrame,
    key: list[str],
    schema: T.StructType,
    buckets: int,
    made: Callable[[DataFrame], DataFrame] | None,
) -> DataFrame:
    """New rows in the tasks of their buckets, to which what `made` adds is not shuffled."""
    whole = made(new) if made else new
    rows = whole.withColumn(BUCKET, bucket_of(key, buckets))
    if made is None:
        return _by_bucket(rows.select(*schema.names, BUCKET), buckets)
    return made(_by_bucket(rows.select(*new.columns, BUCKET), buckets)).select(*schema.names, BUCKET)


def _by_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    """A task for each bucket; by the hash of its number, some tasks would hold several and others none."""
    return rows.repartitionById(buckets, BUCKET)


def _placed_in_slices(
    pieces: Sequence[DataFrame],
    folder: str,
    key: list[str],
    schema: T.StructType,
    buckets: int,
    made: Callable[[DataFrame], DataFrame] | None,
) -> Iterator[DataFrame]:
    """As `_placed`, for rows that come in pieces: as many slices, each with all rows of its buckets.

    The pieces are written by slice first; what a slice was made of goes when the next one is asked for.
    """
    spark, slices, of = pieces[0].sparkSession, len(pieces), "_slice"
    names = pieces[0].columns if made else schema.names
    for piece in pieces:
        rows = (made(piece) if made else piece).withColumn(BUCKET, bucket_of(key, buckets))
        rows = rows.select(*names, BUCKET, F.pmod(BUCKET, F.lit(slices)).alias(of))
        with shuffles_released(spark):
            rows.write.mode("append").options(**_PACKED).partitionBy(of).parquet(folder)
    for number in range(slices):
        held = spark.read.schema(rows.schema).parquet(folder).where(F.col(of) == number).drop(of)
        whole = _by_bucket(held, buckets)
        yield (made(whole) if made else whole).select(*schema.names, BUCKET)
        versions.delete(spark, f"{folder}/{of}={number}")


def _merged_in_slices(
    spark: SparkSession,
    offered: str,
    path: str,
    key: list[str],
    schema: T.StructType,
    buckets: int,
    slices: int,
) -> Iterator[DataFrame]:
    """New rows, offered by bucket, and those that the table holds in their buckets, in slices of the buckets.

    What was offered of a slice goes when the next one is asked for.
    """
    full = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    found = versions.children(spark, offered)
    touched = sorted(int(name.partition("=")[2]) for name in found if name.startswith(f"{BUCKET}="))
    if not touched:
        yield spark.createDataFrame([], full)
    newest = Window.partitionBy(BUCKET, *key).orderBy("_old")
    for number in range(slices):
        own = [bucket for bucket in touched if bucket % slices == number]
        if not own:
            continue
        folders = [f"{offered}/{BUCKET}={bucket}" for bucket in own]
        rows = spark.read.schema(full).option("basePath", offered).parquet(*folders)
        existing = read_parts(spark, path, schema, read_index(spark, path).where(F.col(BUCKET).isin(own)), [BUCKET])
        both = rows.withColumn("_old", F.lit(False)).unionByName(existing.withColumn("_old", F.lit(True)))
        # Old rows behind a new one go; two new ones of a key both stay, and break the rule.
        yield (
            _by_bucket(both, buckets)
            .withColumn("_first_old", F.first("_old").over(newest))
            .where(~F.col("_old") | F.col("_first_old"))
            .drop("_old", "_first_old")
        )
        for folder in folders:
            versions.delete(spark, folder)


def bucket_count(spark: SparkSession, path: str, otherwise: int) -> int:
    """The number of buckets is kept from the first write on."""
    if not exists(spark, path):
        return otherwise
    row = read_index(spark, path).select("buckets").first()
    return row[0] if row else otherwise


class Sums:
    """Counts of a table's rows by few columns, kept beside it and changed along with it."""

    def __init__(self, columns: list[str]):
        self.columns = columns

    def of(self, rows: DataFrame, sign: int = 1) -> DataFrame:
        counted = rows.groupBy(*self.columns).agg(F.count(F.lit(1)).alias("files"))
        return counted.withColumn("files", F.col("files") * sign)

    def write(self, parts: list[DataFrame], path: str, slices: int = 1) -> str:
        """Add up counts and changes, in slices by group; groups without rows go."""
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        name = f"s{uuid4().hex}"
        for own in versions.slices_of(whole, slices, *self.columns):
            summed = own.groupBy(*self.columns).agg(F.sum("files").alias("files"))
            with shuffles_released(summed.sparkSession):
                summed.where("files > 0").write.mode("append").parquet(f"{path}/sums/{name}")
        return name

    def read(self, spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
        """The counts that belong to the visible parts."""
        own = T.StructType([schema[c] for c in self.columns] + [T.StructField("files", T.LongType())])
        row = read_index(spark, path).select("sums").first() if exists(spark, path) else None
        if row is None or row[0] is None:
            return spark.createDataFrame([], own)
        return spark.read.schema(own).parquet(f"{path}/sums/{row[0]}")


def _check_parents(parents: Mapping[tuple[str, ...], DataFrame], counts: DataFrame, path: str) -> None:
    """Parents are looked up for the few groups of the sums, not for each row."""
    broken = {}
    for columns, parent in parents.items():
        used = counts.groupBy(*columns).agg(F.sum("files").alias("files"))
        lost = used.dropna(subset=list(columns)).join(parent.select(*columns), list(columns), "left_anti")
        found = lost.agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]
        if found:
            broken[f"no parent for {', '.join(columns)}"] = found
    if broken:
        raise versions.KeyViolation(path, broken)


def write_buckets(
    new: DataFrame | Sequence[DataFrame],
    path: str,
    key: list[str],
    schema: T.StructType,
    buckets: int,
    replace: bool,
    order_by: list[str] | None = None,
    sums: Sums | None = None,
    parents: Mapping[tuple[str, ...], DataFrame] | None = None,
    totals: Mapping[str, Column] | None = None,
    options: Mapping[str, str] | None = None,
    made: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[str, int]:
    """Replace the table, or merge new rows by key: only buckets that they fall into are read and written.

    New rows are written once, by bucket; their touched buckets are then merged with what the table
    holds there in one shuffle by bucket, in which new rows come before old ones of the same
    key. A key that is given twice, or a row without its parent (looked up by the columns of
    `sums`), is refused: the new parts are deleted, unread. Returns totals over all rows of the
    written buckets.

    Columns that follow from those of `new` can be left to `made`, which adds them and changes no other: they
    tell the bucket, and are made again behind the shuffle instead of being carried through it.

    `new` may come in pieces. Then the table is filled in as many slices of its buckets, and no more than one piece or
    slice is shuffled at a time. Of what is refused no more than one slice is written.
    """
    pieces = [new] if isinstance(new, DataFrame) else list(new)
    spark = pieces[0].sparkSession
    buckets = buckets if replace else bucket_count(spark, path, buckets)
    changes, offered = [], f"{path}/data/offered=o{uuid4().hex}"
    if not replace and exists(spark, path):
        for piece in pieces:
            placed = _placed(piece, key, schema, buckets, made)
            with shuffles_released(spark):
                # Sorted by key, rows take less room.
                placed.sortWithinPartitions(BUCKET, *key).write.mode("append").options(**_PACKED).partitionBy(
                    BUCKET
                ).parquet(offered)
        touched = spark.read.schema(f"{BUCKET} int").parquet(offered).distinct()
        chosen = read_index(spark, path).join(touched, BUCKET, "left_semi")
        if sums:
            changes = [sums.read(spark, path, schema), sums.of(read_parts(spark, path, schema, chosen), -1)]
        merged = _merged_in_slices(spark, offered, path, key, schema, buckets, len(pieces))
    elif len(pieces) > 1:
        merged = _placed_in_slices(pieces, offered, key, schema, buckets, made)
    else:
        merged = _placed(pieces[0], key, schema, buckets, made)
    try:
        entries, found = fill_parts(
            merged,
            path,
            [BUCKET],
            Rules(key, bound=[BUCKET]),
            [BUCKET, *(order_by or [])],
            totals,
            {"buckets": F.lit(buckets)},
            {**_PACKED, **(options or {})},
            attempt := f"attempt=a{uuid4().hex}",
        )
    finally:
        versions.delete(spark, offered)
    kept = None
    if sums:
        written = read_parts(spark, path, schema, entries)
        kept = sums.write([*changes, sums.of(written)], path, len(pieces))
        if parents:
            try:
                _check_parents(parents, spark.read.parquet(f"{path}/sums/{kept}"), path)
            except versions.KeyViolation:
                for folder in (f"data/{attempt}", f"sums/{kept}"):
                    versions.delete(spark, f"{path}/{folder}")
                raise
    publish_index(entries, path, [BUCKET], replace, kept)
    return found


def remove_unnamed(spark: SparkSession, path: str) -> list[str]:
    """Delete data folders that the newest index does not name; returns their names.

    For quiet times: a reader of an older index, or a writer that has not finished, would lose
    its files.
    """
    named = {r["folder"].split("/")[0] for r in read_index(spark, path).select("folder").collect()}
    hadoop = spark._jvm.org.apache.hadoop.fs
    data = hadoop.Path(f"{path}/data")
    fs = data.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in fs.listStatus(data) if fs.exists(data) else []:
        name = status.getPath().getName()
        if name not in named:
            fs.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)
