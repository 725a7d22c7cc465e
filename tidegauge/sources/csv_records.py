"""Records of CSV files that are read in parts, where quoted cells may hold line breaks.

Files are read as lines, so that a large one is split between tasks wherever Spark likes. A line alone
does not tell whether it starts inside a quoted cell, but it tells what follows from either start:
`from_record` says whether the line ends inside quotes if a record starts with it, `from_quote` if
quotes are open before it. Such pairs can be put together for any run of lines, first within a part
of a file, then over its parts, and so every line learns how it starts. Only lines of records
that go over several lines are then brought together.

Quotes follow the common rules: they open a cell only at its start, two of them inside a quoted cell
are one, and any other quote is text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Where the reading of a record stands behind a quote.
_TEXT, _OPEN, _CLOSED, _RECORD = range(4)
NOT_CLOSED = "a quote is not closed"
NOT_UTF8 = "not UTF-8 text"


def as_literal(path: str) -> str:
    """A path for Spark's readers, which take some characters as patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _commas(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))


def _read_quotes(text: Column, start: int) -> Column:
    """Where reading stands after the text, `state`, and how many `commas` part its cells."""

    def count(state: Column, part: Column) -> Column:
        return F.when(state == _OPEN, 0).otherwise(_commas(part))

    def step(so_far: Column, part: Column) -> Column:
        """A part and the quote behind it."""
        state = so_far["state"]
        empty = part == ""
        opens = part.endswith(",") | (empty & state.isin(_CLOSED, _RECORD))
        after = F.when(state == _OPEN, _CLOSED).when(opens, _OPEN).otherwise(_TEXT)
        return F.struct(
            after.alias("state"), (so_far["commas"] + count(state, part)).alias("commas")
        )

    parts = F.split(text, '"', -1)
    begin = F.struct(F.lit(start).alias("state"), F.lit(0).alias("commas"))
    read = F.aggregate(F.slice(parts, 1, F.size(parts) - 1), begin, step)
    last = F.element_at(parts, -1)
    return F.struct(
        read["state"].alias("state"), (read["commas"] + count(read["state"], last)).alias("commas")
    )


def ends_inside(text: Column, inside: bool) -> Column:
    """Whether quotes are open behind a line that starts inside a quoted cell, or a record."""
    start = _OPEN if inside else _RECORD
    read = _read_quotes(text, start)["state"] == _OPEN
    return F.when(F.contains(text, F.lit('"')), read).otherwise(F.lit(inside))


def field_count(record: Column) -> Column:
    """Cells of a record."""
    quoted = _read_quotes(record, _RECORD)["commas"]
    return F.when(F.contains(record, F.lit('"')), quoted).otherwise(_commas(record)) + 1


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All lines of the files: `path`, the start of the `block` that a task read, `line` (a number that
    grows within a block), `text`, and what follows from either start.

    The numbers depend on the scan: write the result and go on from there.
    """
    location = F.regexp_replace(F.col("_metadata.file_path"), "^file:(//)?", "")
    lines = spark.read.option("lineSep", "\n").text([as_literal(path) for path in paths])
    return lines.select(
        F.url_decode(F.replace(location, F.lit("+"), F.lit("%2B"))).alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value").alias("text"),
        ends_inside(F.col("value"), False).alias("from_record"),
        ends_inside(F.col("value"), True).alias("from_quote"),
        F.is_valid_utf8("value").alias("is_text"),
    )


def _starts_inside(rows: DataFrame, begin: Column, keys: list[str], order: str, name: str) -> DataFrame:
    """Add whether quotes are open before a row, given how its group begins.

    A row either sets the state whatever it was, or swaps it, or leaves it. So the state follows
    from the last row that set it and the number of swaps since. All of it is one sort.
    """
    group = Window.partitionBy(*keys).orderBy(order)
    upto = group.rowsBetween(Window.unboundedPreceding, 0)
    before = group.rowsBetween(Window.unboundedPreceding, -1)
    swap = F.col("from_record") & ~F.col("from_quote")
    counted = rows.withColumn("_swaps", F.count_if(swap).over(upto))
    sets = F.col("from_record") == F.col("from_quote")
    setting = F.struct(F.col("from_record").alias("to"), F.col("_swaps").alias("swaps"))
    known = counted.withColumn("_set", F.last(F.when(sets, setting), ignorenulls=True).over(before))
    # Swaps before this row, and since the state was set.
    past = F.col("_swaps") - swap.cast("int") - F.coalesce(F.col("_set.swaps"), F.lit(0))
    state = F.coalesce(F.col("_set.to"), begin) != (past % 2 == 1)
    return known.withColumn(name, state).drop("_swaps", "_set")


def _ends(inside: str) -> Column:
    return F.when(F.col(inside), F.col("from_quote")).otherwise(F.col("from_record"))


def read_blocks(lines: DataFrame) -> DataFrame:
    """How each block of a file begins: `inside` a quoted cell, and then in which `record`, the
    line it started with; `ends` tells whether the block ends inside.

    Lines are read without their text here.
    """
    keys = ["path", "block"]
    bare = lines.select(*keys, "line", "from_record", "from_quote")
    either = _starts_inside(bare, F.lit(False), keys, "line", "if_record")
    either = _starts_inside(either, F.lit(True), keys, "line", "if_quote")
    blocks = either.groupBy(*keys).agg(
        F.max_by(_ends("if_record"), "line").alias("from_record"),
        F.max_by(_ends("if_quote"), "line").alias("from_quote"),
        F.max(F.when(~F.col("if_record"), F.col("line"))).alias("last_if_record"),
        F.max(F.when(~F.col("if_quote"), F.col("line"))).alias("last_if_quote"),
    )
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = _starts_inside(blocks, F.lit(False), ["path"], "block", "inside")
    own = F.when(F.col("inside"), F.col("last_if_quote")).otherwise(F.col("last_if_record"))
    return begun.withColumn("own", own).select(
        *keys,
        "inside",
        F.last("own", ignorenulls=True).over(before).alias("record"),
        _ends("inside").alias("ends"),
    )


def file_report(lines: DataFrame) -> DataFrame:
    """Each file with its `first` line, whether a record `breaks` over lines, and what makes it unreadable:
    `problem`."""
    seen = lines.groupBy("path").agg(
        F.min(F.when(F.col("block") == 0, F.col("line"))).alias("first"),
        F.bool_or("from_record").alias("breaks"),
        F.bool_and("is_text").alias("is_text"),
    )
    broken = lines.join(seen.where("breaks").select("path"), "path", "left_semi")
    last = read_blocks(broken).groupBy("path").agg(F.max_by("ends", "block").alias("ends"))
    problem = F.when(~F.col("is_text"), NOT_UTF8).when(F.col("ends"), NOT_CLOSED)
    return seen.join(last, "path", "left").select("path", "first", "breaks", problem.alias("problem"))


def read_records(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Records behind the header of files without a problem: `path`, `block` and `line` of their start, `text`.

    `lines` and `files`, the report of them, are written tables. Lines of files without broken
    records are records as they are and are not shuffled. Blank lines are none; a line
    break at the end of a record may be `\\n` or `\\r\\n`.
    """
    good = files.where(F.col("problem").isNull())
    known = lines.join(good.select("path", "first", "breaks"), "path")
    whole = known.where(~F.col("breaks")).select("path", "block", "line", "first", "text")
    keys = ["path", "block"]
    broken = known.where(F.col("breaks"))
    begins = read_blocks(broken.select(*lines.columns)).select(*keys, "record", F.col("inside").alias("begins"))
    upto = Window.partitionBy(*keys).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    placed = _starts_inside(broken.join(begins, keys), F.col("begins"), keys, "line", "inside")
    start = F.last(F.when(~F.col("inside"), F.col("line")), ignorenulls=True).over(upto)
    placed = placed.withColumn("record", F.coalesce(start, "record")).withColumn("ends", _ends("inside"))
    single = placed.where(~F.col("inside") & ~F.col("ends"))
    several = (
        placed.where(F.col("inside") | F.col("ends"))
        .groupBy("path", "record", "first")
        .agg(
            F.min("block").alias("block"),
            F.sort_array(F.collect_list(F.struct("line", "text"))).alias("lines"),
        )
        .select(
            "path",
            "block",
            F.col("record").alias("line"),
            "first",
            F.array_join(F.col("lines.text"), "\n").alias("text"),
        )
    )
    records = whole.unionByName(single.select(*whole.columns)).unionByName(several)
    text = F.regexp_replace("text", "\r$", "")
    return (
        records.where(F.col("line") != F.col("first"))
        .select("path", "block", "line", text.alias("text"))
        .where(F.trim("text") != "")
    )
