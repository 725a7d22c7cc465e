"""Numbered versions of a table in a folder; a version is read from the moment it is marked.

A version is filled first and marked last, by the job's commit or, where its keys are checked
as it is filled, after that check. So readers see the old table or the new one, never an empty
or half-written one or one that breaks a rule, and nothing is overwritten while it is read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.session import shuffles_released

_MARK = "_SUCCESS"
_UNMARKED = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


class KeyViolation(ValueError):
    """Rows that break a key; `counts` says how many by rule."""

    def __init__(self, path: str, counts: dict[str, int]):
        super().__init__(f"{path}: " + ", ".join(f"{n} rows: {rule}" for rule, n in counts.items()))
        self.counts = counts


def _folder_of(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no folder."""
    folder, fs = _folder_of(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(folder)] if fs.exists(folder) else []


def versions(spark: SparkSession, path: str, marked: bool = True) -> list[int]:
    folder, fs = _folder_of(spark, path)
    if not fs.exists(folder):
        return []
    found = []
    for status in fs.listStatus(folder):
        child = status.getPath()
        number = child.getName().removeprefix("v")
        if number.isdigit() and (not marked or fs.exists(_folder_of(spark, f"{child}/{_MARK}")[0])):
            found.append(int(number))
    return sorted(found)


def mark(spark: SparkSession, folder: str) -> None:
    """Make a filled folder count."""
    name, fs = _folder_of(spark, f"{folder}/{_MARK}")
    fs.create(name).close()


def delete(spark: SparkSession, path: str, recreate: bool = False) -> None:
    folder, fs = _folder_of(spark, path)
    fs.delete(folder, True)
    if recreate:
        fs.mkdirs(folder)


def next_folder(spark: SparkSession, path: str) -> tuple[int, str]:
    version = max(versions(spark, path, marked=False), default=0) + 1
    return version, folder(path, version)


def folder(path: str, version: int) -> str:
    return f"{path}/v{version:08d}"


def read_version(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """The newest marked version; an empty table of the schema when there is none."""
    found = versions(spark, path)
    if not found:
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(folder(path, found[-1]))


class Rules:
    """What must hold for rows that fill a table: a unique key, and parents that are there.

    `parents` maps columns to the table whose key they are; a null column refers to nothing. `bound`
    are columns that follow from the key and by which the rows are distributed already.
    """

    def __init__(
        self,
        key: list[str] | None = None,
        parents: Mapping[tuple[str, ...], DataFrame] | None = None,
        bound: list[str] | None = None,
    ):
        self.key = key
        self.parents = dict(parents or {})
        self.bound = bound or []

    def marked(self, rows: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
        """Rows with helper columns, and the counts of offences to observe.

        Parents are joined on their distinct keys; Spark broadcasts a small parent table.
        """
        offences: dict[str, Column] = {}
        for number, (columns, parent) in enumerate(self.parents.items()):
            mark = f"_parent{number}"
            known = parent.select(*columns).distinct().withColumn(mark, F.lit(True))
            rows = rows.join(known, list(columns), "left")
            refers = F.lit(True)
            for column in columns:
                refers = refers & F.col(column).isNotNull()
            offences[f"no parent for {', '.join(columns)}"] = F.count_if(refers & F.col(mark).isNull())
        if self.key:
            number = F.row_number().over(Window.partitionBy(*self.bound, *self.key).orderBy(F.lit(1)))
            rows = rows.withColumn("_number", number)
            offences[f"{', '.join(self.key)} given again"] = F.count_if(F.col("_number") > 1)
        return rows, offences


def in_slice(number: int, slices: int, *columns: str) -> Column:
    """Whether a row is in one of the slices that its columns deal the rows to; equal values share a slice."""
    return F.pmod(F.xxhash64(*columns), F.lit(slices)) == number


def slices_of(rows: DataFrame, slices: int, *columns: str) -> Iterator[DataFrame]:
    """The rows in so many slices, each of which is a scan of its own."""
    for number in range(slices):
        yield rows if slices == 1 else rows.where(in_slice(number, slices, *columns))


def dealt_anew(
    pieces: Iterable[DataFrame], folder: str, slices: int, *columns: str
) -> Iterator[DataFrame]:
    """Rows that come in pieces, in slices by other columns, equal values of which share a slice.

    Each piece is written below `folder` before the next one is made. What a slice is read from goes when the next
    one is asked for.
    """
    of = "_slice"
    for piece in pieces:
        spark, rows = piece.sparkSession, piece.withColumn(of, F.pmod(F.xxhash64(*columns), F.lit(slices)))
        with shuffles_released(spark):
            # Sorted, equal values stand together and take little room.
            rows.sortWithinPartitions(of, *columns).write.mode("append").option("compression", "zstd").partitionBy(
                of
            ).parquet(folder)
    for number in range(slices):
        yield spark.read.schema(rows.schema).parquet(folder).where(F.col(of) == number).drop(of)
        delete(spark, f"{folder}/{of}={number}")


def fill_all(slices: DataFrame | Iterable[DataFrame], folder: str, *args, **more) -> tuple[DataFrame, dict[str, int]]:
    """As `fill`, for rows or slices of them; returns the rows as stored and the totals, which add up over the slices.

    Slices are written one after the other, and the shuffle files of each go before the next. Behind a slice that
    breaks a rule, offences are counted and nothing is written any more.
    """
    found: dict[str, int] = {}
    broken: dict[str, int] = {}
    for number, rows in enumerate([slices] if isinstance(slices, DataFrame) else slices):
        try:
            if broken:
                _refuse(rows, folder, *args, **more)
                continue
            own = fill(rows, folder, *args, append=number > 0, **more)
        except KeyViolation as violation:
            broken = {r: broken.get(r, 0) + violation.counts.get(r, 0) for r in {**broken, **violation.counts}}
            continue
        found = {name: found.get(name, 0) + value for name, value in own.items()}
    if broken:
        raise KeyViolation(folder, broken)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder), found


def _refuse(rows: DataFrame, folder: str, rules: Rules, *_, **__) -> None:
    """Count the offences of rows that need not be written; raises where there are some."""
    rows, offences = rules.marked(rows)
    with shuffles_released(rows.sparkSession):
        counts = rows.agg(*[value.alias(rule) for rule, value in offences.items()]).first().asDict()
    broken = {rule: n for rule, n in counts.items() if n}
    if broken:
        raise KeyViolation(folder, broken)


def fill(
    rows: DataFrame,
    folder: str,
    rules: Rules | None = None,
    partition_by: list[str] | None = None,
    order_by: list[str] | None = None,
    totals: Mapping[str, Column] | None = None,
    options: Mapping[str, str] | None = None,
    append: bool = False,
) -> dict[str, int]:
    """Write rows into a new folder without its mark, and return totals that were taken on the way.

    With `append` the folder holds other slices of the same rows already.

    Totals and offences are observed in the tasks that write, so nothing is read again. An offence
    raises `KeyViolation` and leaves the folder unmarked and empty.
    """
    names, offences = rows.columns, {}
    if rules:
        rows, offences = rules.marked(rows)
    if order_by:
        rows = rows.sortWithinPartitions(*order_by)
    measured = {"rows": F.count(F.lit(1)), **(totals or {})}
    columns = {f"total {k}": v for k, v in measured.items()} | {f"rule {k}": v for k, v in offences.items()}
    seen = Observation()
    rows = rows.observe(seen, *[value.alias(name) for name, value in columns.items()])
    with shuffles_released(rows.sparkSession):
        rows.select(*names).write.mode("append" if append else "errorifexists").options(
            **_UNMARKED, **(options or {})
        ).partitionBy(*(partition_by or [])).parquet(folder)
    # Without rows Spark may leave out the plan's end, and what is observed there.
    found = seen.get
    broken = {rule: n for rule in offences if (n := found.get(f"rule {rule}"))}
    if broken:
        delete(rows.sparkSession, folder, recreate=True)
        raise KeyViolation(folder, broken)
    return {name: found.get(f"total {name}") or 0 for name in measured}
