"""Near-duplicate documents by SimHash, compared bit plane by bit plane."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.common import all_pieces, settled, stored, texts
from tidegauge.llm.components import components

SHINGLE = 3
RADIUS = 3
SEED = 42
# Fingerprints of a bucket that are compared in one group.
GROUP = 4096
# Query and word pairs whose distances are counted at once.
_AT_ONCE = 1 << 15


def _fingerprint(text: bytes, size: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = max(1, len(words) - size + 1)
    last = ends[min(size, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)],
        np.uint64,
    )
    bits = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)]
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return int(np.packbits(2 * bits > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", size: int = SHINGLE):
    """`row` (a struct of the columns `keep`) and `fp`, 64 bits as a long.

    Words are what stands between ASCII blanks after A-Z became a-z; a shingle is `size`
    words in a row joined by a space, repeats counted, or the whole text if it is shorter.
    A bit is 1 if it is set in more than half of the shingles' XXH64 (seed 42). Null
    and blank text have fingerprint 0.
    """
    rows = docs.select(F.struct(*(docs[c] for c in keep)).alias("row"), docs[text].alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in all_pieces(batches, "text"):
            found = [_fingerprint(value, size) for value in texts(piece.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [piece.column("row"), pa.array(found, pa.int64())], ["row", "fp"]
            )

    return rows.mapInArrow(
        run, T.StructType([rows.schema["row"], T.StructField("fp", T.LongType())])
    )


def masks(radius: int, blocks: int) -> list[int]:
    """Bit masks of which two fingerprints within `radius` agree on one at least.

    The bits fall into `blocks` parts; `radius` differing bits touch `radius` parts at most, so
    some choice of the other parts agrees wholly.
    """
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    found = []
    for chosen in combinations(parts, blocks - radius):
        mask = sum(chosen)
        found.append(mask - (1 << 64) if mask >> 63 else mask)
    return found


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n indices."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def links_within(
    fp: np.ndarray, start: np.ndarray, end: np.ndarray, radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j), start[i] <= j < end[i], whose fingerprints differ in `radius` bits or fewer.

    Fingerprints are turned into 64 bit planes; a plane holds one bit of 64 neighbours in a word. For
    a query and a word, the 64 distances grow together in carry-save counters. Words in which
    every distance has passed the radius are abandoned after each eight planes.
    """
    n = len(fp)
    words = -(-n // 64)
    bits = np.zeros((words * 64, 64), np.uint8)
    bits[:n] = np.unpackbits(fp.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    planes = np.packbits(bits.T, axis=1, bitorder="little")
    planes = np.ascontiguousarray(planes).view(np.uint64)
    flips = (bits[:n].T.astype(np.int64) * -1).view(np.uint64)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    first, last = start // 64, -(-end // 64)
    count = np.where(end > start, last - first, 0)
    ends = np.cumsum(count)
    counters = max(1, radius.bit_length())
    at = 0
    while at < n:
        # Whole queries until the pairs are many; one query with more is taken alone.
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + _AT_ONCE, "right")))
        own = np.repeat(np.arange(at, to), count[at:to])
        skip = np.repeat(ends[at:to] - count[at:to], count[at:to])
        word = first[own] + (np.arange(len(own)) + base - skip)
        low = np.clip(start[own] - word * 64, 0, 63).astype(np.uint64)
        high = np.clip(end[own] - word * 64, 1, 64).astype(np.uint64)
        live = (full << low) & (full >> (np.uint64(64) - high))
        sums = [np.zeros(len(own), np.uint64) for _ in range(counters)]
        for plane in range(64):
            carry = planes[plane, word] ^ flips[plane, own]
            for i in range(counters):
                sums[i], carry = sums[i] ^ carry, sums[i] & carry
            live &= ~carry
            if plane % 8 == 7:
                alive = live != 0
                if not alive.all():
                    own, word, live = own[alive], word[alive], live[alive]
                    sums = [x[alive] for x in sums]
                if not len(own):
                    break
        if len(own):
            lanes = np.unpackbits(live.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            pair, lane = np.nonzero(lanes)
            i, j = own[pair], word[pair] * 64 + lane
            if radius + 1 != 1 << counters:
                near = np.bitwise_count(fp[i] ^ fp[j]) <= radius
                i, j = i[near], j[near]
            yield i, j
        at = to


def _compare(radius: int):
    """Rows sorted by group (`mask, key, lower, upper`), side and `fp`, to a forest of links."""

    def forest(group: np.ndarray, side: np.ndarray, fp: np.ndarray, alone: np.ndarray):
        n = len(fp)
        change = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        sizes = np.diff(np.r_[change, n])
        end = np.repeat(change + sizes, sizes)
        # Within a chunk a query meets what follows it; between two chunks the left side
        # meets the right one.
        right = np.repeat(change + np.add.reduceat(1 - side, change), sizes)
        start = np.where(alone, np.arange(n) + 1, right)
        stop = np.where(alone | (side == 0), end, start)
        label = np.arange(n)
        for i, j in links_within(fp, start, stop, radius):
            label = _roots(n, np.r_[label, i], np.r_[np.arange(n), j])
        tied = np.flatnonzero(label != np.arange(n))
        return pa.RecordBatch.from_arrays(
            [pa.array(fp[tied].view(np.int64)), pa.array(fp[label[tied]].view(np.int64))], ["a", "b"]
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            rest = now if rest is None else pa.concat_tables([rest, now])
            group, *_ = _columns(rest)
            if not len(group):
                continue
            # The last group may go on in the next batch.
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield forest(*(x[:cut] for x in _columns(rest)))
                rest = rest.slice(cut)
        if rest is not None and rest.num_rows:
            yield forest(*_columns(rest))

    def _columns(table: pa.Table):
        names = ("mask", "key", "lower", "upper")
        ids = [table.column(c).to_numpy() for c in names]
        new = np.zeros(len(ids[0]), bool)
        for x in ids:
            new[1:] |= x[1:] != x[:-1]
        return (
            np.cumsum(new),
            table.column("side").to_numpy().astype(np.int64),
            table.column("fp").to_numpy().view(np.uint64),
            ids[2] == ids[3],
        )

    return run


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges `a, b` that connect whatever fingerprints (`fp`, distinct) within `radius` connect.

    Fingerprints meet in buckets that agree on a mask. A bucket of more than `GROUP`
    is dealt into chunks, and every pair of chunks is a group of its own, so that no task holds
    a whole hot bucket. A group gives a spanning forest of its links, not all of them.
    """
    keyed = prints.select(
        "fp",
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                    for i, m in enumerate(masks(radius, radius + 2))
                )
            )
        ).alias("at"),
    ).select("fp", "at.mask", "at.key")
    sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / (GROUP // 2)).cast("int")
    met = keyed.join(sizes, ["mask", "key"]).withColumn(
        "chunks", F.when(F.col("n") <= GROUP, 1).otherwise(chunks)
    )
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    dealt = (
        met.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "mask",
            "key",
            F.least("own", "other").alias("lower"),
            F.greatest("own", "other").alias("upper"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
            "fp",
        )
    )
    groups = ["mask", "key", "lower", "upper"]
    return (
        dealt.repartition(*groups)
        .sortWithinPartitions(*groups, "side", "fp")
        .mapInArrow(_compare(radius), "a long, b long")
    )


def groups(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """`fp, root, component_id`: the smallest `doc_id` reachable from each distinct fingerprint.

    `prints` holds `doc_id, fp`. Rows with equal fingerprints are one node, so a thousand
    copies cost one. Null ids are passed over; a group of them only has a null id.
    """
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    roots = components(stored(links(nodes.select("fp"), radius), "links"))
    tied = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = tied.groupBy("root").agg(F.min("least").alias("component_id"))
    return tied.join(smallest, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """`doc_id, fp, component_id` for each row of `docs`.

    Documents link if their fingerprints differ in `radius` bits or fewer; a component
    is all that is reachable. No link is missed. Repeated rows give repeated rows. An empty
    table gives no rows.
    """
    prints = stored(
        fingerprints(docs, ["doc_id"], size=size).select("row.doc_id", "fp"), "documents"
    )
    found = groups(prints, radius)
    return prints.join(found, "fp").select("doc_id", "fp", "component_id")


def stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id.

    Rows that repeat that id within the group are copies too; the first as read stays. In a
    group without any id the first row stays.
    """
    docs = settled(docs)
    numbered = docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row_id"))
    prints = stored(
        fingerprints(
            numbered.select("row_id", "doc.doc_id", "doc.text"), ["row_id", "doc_id"]
        ).select("row.*", "fp"),
        "documents",
    )
    tied = prints.join(groups(prints.select("doc_id", "fp")), "fp")
    kept = stored(
        tied.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min("row_id").alias("kept"))
        .select("kept"),
        "kept",
    )
    # The numbers grow with the documents, so they are merged and not sent to every task.
    same = F.col("row_id") == F.col("kept")
    return numbered.join(kept.hint("merge"), same, "left_semi").select("doc.*")
