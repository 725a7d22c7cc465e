"""Benchmark decontamination by winnowing, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import plain_words, settled, stored

WINDOW = 10


def _shape(length: int) -> tuple[int, int]:
    """Words of a fingerprint, and fingerprints of a window, for windows of `length` words.

    A run of `length` words holds `length - size + 1` fingerprints, one of which is the smallest, so
    each such run that a document shares with an item gives a shared fingerprint.
    """
    size = (length + 1) // 2
    return size, length - size + 1


def _grams(hashes: str, size: int) -> Column:
    """Hashes of all runs of `size` words, from the column of the words' hashes."""
    if size == 1:
        return F.col(hashes)

    def gram(x: Column, i: Column) -> Column:
        return F.xxhash64(x, *(F.get(F.col(hashes), i + j) for j in range(1, size)))

    return F.slice(
        F.transform(hashes, gram), F.lit(1), F.greatest(F.size(hashes) - (size - 1), F.lit(0))
    )


def _with_grams(rows: DataFrame, size: int) -> DataFrame:
    """Adds `hashes` of the `words` and `grams` of `size` words."""
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    return rows.withColumn("grams", _grams("hashes", size))


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The distinct windows of all items, and which items hold them.

    First `wid, length, fp, shift, win`: a window of `length` words `win`, the smallest of its fingerprints,
    and where in the window that one begins. Then `wid, item_id`. An item of fewer words than
    `window` is one window; items without words have none.
    """
    rows = (
        items.select(
            items["item_id"].alias("item_id"),
            plain_words(items["text"]).alias("words"),
        )
        .withColumn("n", F.size("words"))
        .where("n > 0")
        .withColumn("length", F.least(F.col("n"), F.lit(window)))
    )
    parts = None
    for length in range(1, window + 1):
        size, grams = _shape(length)
        own = _with_grams(rows.where(F.col("length") == length), size)
        own = own.withColumn(
            "at", F.explode(F.sequence(F.lit(0), F.greatest(F.col("n") - length, F.lit(0))))
        ).select(
            "item_id",
            "length",
            F.slice("words", F.col("at") + 1, F.lit(length)).alias("win"),
            F.slice("grams", F.col("at") + 1, F.lit(grams)).alias("near"),
        )
        own = own.withColumn("fp", F.array_min("near")).select(
            "item_id", "length", "win", "fp", (F.array_position("near", F.col("fp")) - 1).alias("shift")
        )
        parts = own if parts is None else parts.unionByName(own)
    parts = stored(parts.distinct(), "item_windows")
    windows = stored(
        parts.select("length", "fp", "shift", "win")
        .distinct()
        .withColumn("wid", F.monotonically_increasing_id()),
        "windows",
    )
    held = stored(
        parts.join(windows.select("wid", "length", "win"), ["length", "win"]).select("wid", "item_id"),
        "held",
    )
    return windows, held


def _selected(rows: DataFrame, length: int) -> DataFrame:
    """`row_id, length, fp, at`: fingerprints that some window of `length` words has as its smallest.

    All positions of an equal smallest value are selected, so the choice depends on a window's words alone.
    """
    size, grams = _shape(length)
    rows = _with_grams(rows, size).select("row_id", "grams")
    if grams == 1:
        chosen = F.transform("grams", lambda x, i: F.struct(i.alias("at"), x.alias("fp")))
    else:
        smallest = F.transform(
            "grams",
            lambda x, i: F.least(x, *(F.get(F.col("grams"), i + j) for j in range(1, grams))),
        )
        # The smallest of each window; the last runs of words begin none.
        windows = F.greatest(F.size("grams") - (grams - 1), F.lit(0))
        rows = rows.withColumn("least", F.slice(smallest, F.lit(1), windows))
        # A run is selected if it is the smallest of some window that holds it.
        chosen = F.filter(
            F.transform(
                "grams",
                lambda x, i: F.struct(
                    i.alias("at"),
                    x.alias("fp"),
                    F.greatest(*(F.get(F.col("least"), i - j) for j in range(grams))).alias("most"),
                ),
            ),
            lambda s: s["fp"] == s["most"],
        )
    return rows.select("row_id", F.explode(chosen).alias("s")).select(
        "row_id", F.lit(length).alias("length"), F.col("s.fp").alias("fp"), F.col("s.at").alias("at")
    )


def _worded(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        docs["doc_id"].alias("doc_id"),
        plain_words(docs[text]).alias("words"),
    )


def spans(docs: DataFrame, windows: DataFrame, text: str = "text") -> DataFrame:
    """`row_id, doc_id, n_words` of each row of `docs` and `found`: `start, length, wid` of each place
    where a benchmark window stands.

    Selected fingerprints of the documents meet those of the windows; the fingerprint table is written first,
    so that Spark broadcasts it only if the file is small enough. Each hit is extended both ways to the window
    it belongs to and compared word by word.
    """
    prints = stored(windows.select("length", "fp").distinct(), "prints")
    lengths = sorted(r[0] for r in prints.select("length").distinct().collect())  # ten at most
    hits = None
    for length in lengths:
        own = _selected(_worded(docs, text), length).join(
            prints.where(F.col("length") == length).drop("length"), "fp", "left_semi"
        )
        hits = own if hits is None else hits.unionByName(own)
    words = _worded(docs, text)
    empty = F.array().cast("array<struct<start:int,length:int,wid:bigint>>")
    if hits is None:
        return words.select("row_id", "doc_id", F.size("words").cast("long").alias("n_words"), empty.alias("found"))
    near = (
        stored(hits, "hits")
        .join(windows, ["length", "fp"])
        .withColumn("start", (F.col("at") - F.col("shift")).cast("int"))
        .where("start >= 0")
        .groupBy("row_id")
        .agg(F.collect_set(F.struct("start", "length", "wid", "win")).alias("near"))
    )
    same = F.filter(
        "near", lambda c: F.slice(F.col("words"), c["start"] + 1, c["length"]) == c["win"]
    )
    found = F.transform(
        same, lambda c: F.struct(c["start"].alias("start"), c["length"].alias("length"), c["wid"].alias("wid"))
    )
    return words.join(stored(near, "near"), "row_id", "left").select(
        "row_id",
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.coalesce(found, empty).alias("found"),
    )


def decontaminate(
    docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW
) -> DataFrame:
    """What each document shares with the benchmark.

    Words are plain words after A-Z became a-z. A window is `window` consecutive words of an item, or all
    words of a shorter one. One row for each row of `docs`: `row_id, doc_id, n_words, n_hit` (words inside any
    occurrence of a window), `found` (the occurrences) and `item_ids` (distinct items with a window here, as strings
    in order). Null and blank texts have no words and no hits; items without words hit
    nothing; an item that is repeated counts once; an empty benchmark hits nothing.
    """
    docs = settled(docs)
    windows, held = benchmark_windows(items, window)
    rows = stored(spans(docs, windows, text), "spans")
    ids = (
        rows.select("row_id", F.explode("found.wid").alias("wid"))
        .distinct()
        .join(held, "wid")
        .select("row_id", F.col("item_id").cast("string").alias("item_id"))
        .distinct()
        .groupBy("row_id")
        .agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))
    )
    covered = F.array_distinct(
        F.flatten(
            F.transform(
                F.array_distinct(
                    F.transform("found", lambda c: F.struct(c["start"].alias("s"), c["length"].alias("n")))
                ),
                lambda c: F.sequence(c["s"], c["s"] + c["n"] - 1),
            )
        )
    )
    return rows.join(ids, "row_id", "left").select(
        "row_id",
        "doc_id",
        "n_words",
        F.size(covered).cast("long").alias("n_hit"),
        "found",
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a window of the benchmark go; all others stay as they are."""
    docs = settled(docs)
    items = spark.read.parquet(f"{folder.rstrip('/')}/benchmark.parquet")
    windows, _ = benchmark_windows(items)
    hit = stored(spans(docs, windows).where(F.size("found") > 0).select("row_id"), "contaminated")
    numbered = docs.select(
        F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("number")
    )
    return numbered.join(hit, F.col("number") == F.col("row_id"), "left_anti").select("doc.*")
