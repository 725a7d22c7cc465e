"""Removing repeated word runs: winnowed anchors, extended to whole windows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import all_pieces, discard, settled, stored, texts, with_row_id
from tidegauge.llm.vocabulary import rolled, split_all, within, word_hashes

WINDOW = 20
ANCHOR = 8
# A place is a document's rank and a word's number; a text of 2 GB has no more words.
_WORD_BITS = 28


def _anchors(
    first: np.ndarray, ends: np.ndarray, window: int, anchor: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end: hashes of all runs of `anchor` words, the windows that stay in one
    text, and for each of these the run it selects.

    A window selects the smallest hash among its runs, the leftmost of equals: equal windows
    select the same run, so every repeated window has a repeated anchor.
    """
    runs = rolled(first, anchor)
    starts = within(ends, window)
    if not len(starts):
        return runs, starts, starts
    view = np.lib.stride_tricks.sliding_window_view(runs, window - anchor + 1)
    return runs, starts, starts + view.argmin(axis=1)[starts]


def anchors(rows: DataFrame, window: int, anchor: int) -> DataFrame:
    """`hash, row_id, at`: the selected anchors of all texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in all_pieces(batches, "text"):
            words, ends = split_all(texts(piece.column("text")))
            runs, _, chosen = _anchors(word_hashes(words), ends, window, anchor)
            at = np.unique(chosen)
            owner = np.searchsorted(ends, at, "right") - 1
            yield pa.RecordBatch.from_pydict(
                {
                    "hash": pa.array(runs[at].view(np.int64)),
                    "row_id": pa.array(piece.column("row_id").to_numpy()[owner], pa.int64()),
                    "at": pa.array(at - ends[owner], pa.int32()),
                }
            )

    return rows.select("row_id", "text").mapInArrow(run, "hash long, row_id long, at int")


def _ranks(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`row_id, rank`: the order of documents by id, null last, then as read; before it, the table it
    is read from."""
    ranged = stored(
        rows.select("doc_id", "row_id")
        .repartitionByRange(F.col("doc_id").asc_nulls_last(), "row_id")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "row_id")
        .select(
            "row_id",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at"),
        ),
        "ranged",
    )
    before, offsets = 0, []
    for row in sorted(ranged.groupBy("part").count().collect()):  # one row for each range
        offsets.append((row["part"], before))
        before += row["count"]
    if before >> (63 - _WORD_BITS):
        raise OverflowError(f"{before} documents do not fit beside the word numbers of a place")
    # One row for each range: as many as the session has shuffle partitions.
    table = rows.sparkSession.createDataFrame(offsets, "part int, before long")
    return ranged, ranged.join(table, "part").select(
        "row_id", (F.col("at") + F.col("before")).alias("rank")
    )


def _squeezed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one: they are shuffled once."""
    press = zstandard.ZstdCompressor(level=1)
    for piece in all_pieces(batches, "text"):
        packed = [press.compress(text) for text in texts(piece.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [piece.column("row_id"), piece.column("doc_id"), pa.array(packed, pa.binary())],
            ["row_id", "doc_id", "packed"],
        )


def _unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdDecompressor()
    for piece in all_pieces(batches, "packed", 1 << 20):
        whole = [press.decompress(packed) for packed in piece.column("packed").to_pylist()]
        columns = {n: piece.column(n) for n in piece.schema.names if n != "packed"}
        columns["text"] = pa.array(whole, pa.large_binary())
        yield pa.RecordBatch.from_pydict(columns)


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _extend(window: int, anchor: int):
    """From the repeated anchors of a text to the windows that select them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in all_pieces(_unpacked(batches), "text"):
            values = texts(piece.column("text"))
            words, ends = split_all(values)
            repeated = [
                np.array(at or [], np.int64) + start
                for at, start in zip(piece.column("repeated").to_pylist(), ends[:-1], strict=True)
            ]
            first = word_hashes(words)
            _, starts, chosen = _anchors(first, ends, window, anchor)
            marked = np.zeros(len(words) + 1, bool)
            marked[np.concatenate(repeated)] = True
            starts = starts[marked[chosen]]
            one = rolled(first, window, 0)[starts].view(np.int64)
            two = rolled(word_hashes(words, 1), window, 1)[starts].view(np.int64)
            cuts = np.searchsorted(starts, ends)
            some = np.diff(cuts) > 0
            owner = np.searchsorted(ends, starts, "right") - 1
            offsets = pa.array(cuts, pa.int32())
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(x))
                for x in ((starts - ends[owner]).astype(np.int32), one, two)
            ]
            shas = [
                None if held else _sha(words[a:b])
                for held, a, b in zip(some.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True)
            ]
            left = [value if held else None for value, held in zip(values, some.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    piece.column("row_id"),
                    piece.column("rank"),
                    pa.array(np.diff(ends), pa.int64()),
                    pa.array(shas, pa.string()),
                    pa.array(left, pa.binary()).cast(pa.string()),
                    *lists,
                ],
                ["doc_id", "row_id", "rank", "n_words", "sha", "text", "starts", "one", "two"],
            )

    return run


def _cut(window: int):
    """Drop the words of all windows but those that come first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in all_pieces(batches, "text"):
            starts = piece.column("starts").to_pylist()
            firsts = piece.column("firsts").to_pylist()
            removed, shas, kept_texts = [], [], []
            for text, own, first in zip(texts(piece.column("text")), starts, firsts, strict=True):
                words = text.split()
                later = np.setdiff1d(np.array(own, np.int64), np.array(first or [], np.int64))
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, later, 1)
                np.add.at(edge, later + window, -1)
                covered = np.cumsum(edge)[: len(words)] > 0
                kept = [w for w, gone in zip(words, covered.tolist(), strict=True) if not gone]
                removed.append(int(covered.sum()))
                shas.append(_sha(kept))
                kept_texts.append(b" ".join(kept))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    piece.column("n_words"),
                    pa.array(removed, pa.int64()),
                    pa.array(shas, pa.string()),
                    pa.array(kept_texts, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    return run


def dedup_substrings(
    docs: DataFrame, text: str = "text", window: int = WINDOW, anchor: int = ANCHOR
) -> DataFrame:
    """Words left of each text when only the first occurrence of a repeated run stays.

    A word goes if a run of `window` words around it also starts earlier: in a document with a smaller
    id (null is the largest; rows that share an id count as read), or earlier in its own. Texts meet on
    winnowed anchors of `anchor` words. A repeated anchor is extended both ways to every window that
    selects it; windows with the same 128-bit hash are one class, whose first place is found by a
    minimum that combines before the shuffle. A class of a thousand copies thus costs a thousand
    rows, not a million pairs; overlapping windows join into maximal runs when words are dropped.

    One row for each row of `docs`: `doc_id, n_words, n_removed, kept_sha256` and `kept`, the words left,
    joined by a space (null where nothing went: the text's own words). Null and blank texts
    have no words. An empty table gives no rows.
    """
    rows = settled(docs.select(docs["doc_id"].alias("doc_id"), docs[text].alias("text")))
    rows = with_row_id(rows, "doc_id", "text")
    found = anchors(rows, window, anchor)
    twice = found.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    repeated = stored(found.join(twice, "hash", "left_semi").select("row_id", "at"), "repeated")
    ranged, ranks = _ranks(rows)
    ids = stored(
        ranks.join(
            repeated.groupBy("row_id").agg(F.collect_list("at").alias("repeated")), "row_id", "left"
        ),
        "ids",
    )
    kind = (
        "doc_id long, row_id long, rank long, n_words long, sha string, text string, "
        "starts array<int>, one array<long>, two array<long>"
    )
    packed = rows.select("row_id", F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _squeezed, "row_id long, doc_id long, packed binary"
    )
    windows = stored(
        packed.join(ids, "row_id")
        .select("doc_id", "row_id", "rank", "repeated", "packed")
        .mapInArrow(_extend(window, anchor), kind),
        "windows",
    )
    discard(repeated, ranged, ids)
    place = F.shiftleft("rank", _WORD_BITS) + F.col("at.starts")
    firsts = (
        windows.where("sha is null")
        .select("rank", F.explode(F.arrays_zip("starts", "one", "two")).alias("at"))
        .groupBy("at.one", "at.two")
        .agg(F.min(place).alias("place"))
        .groupBy(F.shiftright("place", _WORD_BITS).alias("rank"))
        .agg(F.collect_list(F.col("place").bitwiseAND(F.lit((1 << _WORD_BITS) - 1))).alias("firsts"))
    )
    kind = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    cut = (
        windows.where("sha is null")
        .join(firsts, "rank", "left")
        .select("doc_id", "n_words", "text", "starts", "firsts")
        .mapInArrow(_cut(window), kind)
    )
    whole = windows.where("sha is not null").select(
        "doc_id",
        "n_words",
        F.lit(0).cast("long").alias("n_removed"),
        F.col("sha").alias("kept_sha256"),
        F.lit(None).cast("string").alias("kept"),
    )
    return cut.unionByName(whole)
