"""Written intermediate tables and the word rules that several operators share."""

from __future__ import annotations

import re
import string
import uuid
import weakref
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.session import shared_folder, shuffles_released

# Words after A-Z became a-z: digits, a-z and everything outside ASCII.
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Words as written: whatever stands between ASCII blanks.
SPACED_WORD = r"[^\x20\x09-\x0D]+"


_places: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def stored(table: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    This cuts the lineage in a way that survives lost executors, and lets Spark
    plan later joins by the size of the written files.
    """
    spark = table.sparkSession
    path = f"{shared_folder(spark, 'llm')}/{uuid.uuid4().hex}/{name}"
    with shuffles_released(spark):
        table.write.option("compression", "zstd").parquet(path)
    found = spark.read.schema(table.schema).parquet(path)
    _places[found] = path
    return found


def discard(*tables: DataFrame) -> None:
    """Delete stored tables from which all that is needed has been written."""
    for table in tables:
        spark = table.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(_places.pop(table))
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def settled(table: DataFrame) -> DataFrame:
    """The table, in a form of which every scan gives the same rows in the same order.

    Rows can be numbered in several scans of such a table. Files that are only projected and
    filtered are one as they are; whatever comes of a shuffle, a sample, a limit or of Python is
    written first.
    """
    plan = table._jdf.queryExecution().optimizedPlan()
    steps = [line.lstrip(" :+-") for line in plan.toString().splitlines()]
    files = all(re.match(r"(Project|Filter|Relation|LocalRelation)\b", step) for step in steps)
    return table if files and plan.deterministic() else stored(table, "settled")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def plain_words(text: Column) -> Column:
    """Plain words of a text after A-Z became a-z; null has none.

    Everything in ASCII that is no word character becomes a blank, which is
    several times faster than matching `PLAIN_WORD`.
    """
    gaps = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
    spaced = F.translate(
        F.coalesce(text, F.lit("")),
        string.ascii_uppercase + gaps,
        string.ascii_lowercase + " " * len(gaps),
    )
    return F.array_remove(F.split(spaced, " "), "")


def with_row_id(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns and a number for each row, `row_id`.

    Repeated rows get different numbers. The numbers are the same in each scan of a `settled` table.
    """
    return docs.select(*(docs[c] for c in columns)).withColumn(
        "row_id", F.monotonically_increasing_id()
    )


def texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def pieces(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a piece holds about `most` bytes of text, one row at least."""
    sizes = [len(value) for value in texts(batch.column(column))]
    start, held = 0, 0
    for at, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def all_pieces(
    batches: Iterable[pa.RecordBatch], column: str, most: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from pieces(batch, column, most)
