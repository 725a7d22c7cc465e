"""Hard negatives by inner product: length buckets and sorted coordinate lists.

A task sorts the vectors of a batch by length and cuts them into buckets of similar length. For an
anchor that needs a score, the longest vector of a bucket tells the least cosine a member must have;
buckets that would need more than 1 are skipped. Otherwise the cosine bounds each coordinate of a
member of length one: with angle a between the anchor and an axis, the member's angle to that axis
is within arccos of the least cosine of a. For the coordinates in which the anchor is largest,
the bucket's sorted lists turn such a range of values into a run of members; those in every
run are compared exactly. Where a sample of the anchors tells that the runs would hold much of a bucket,
products of whole matrices give the exact scores of all its members for less than it takes to leave some out.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import stored
from tidegauge.session import shared_folder

SCALE = 256.0
POSITIVES = 5
NEGATIVES = 5
# A negative's score in percent of the positive's.
LOW, HIGH = 80, 100
# Coordinates of an anchor that are looked up.
FOCUS = 4
# Members of a bucket, and how much shorter than the longest one they may be.
BUCKET, NARROW, FEWEST = 1024, 0.9, 64
# Bytes of the anchors that go to every task at once, and pairs compared at once.
ANCHOR_BYTES = 8 << 20
PAIRS = 1 << 16
# Anchors that a matrix product takes at once, and those that tell how much of a bucket the ranges leave: from
# this share on its members are not looked up.
ROWS, SAMPLE, MUCH = 512, 64, 1 / 32
_LEAST, _LARGEST = -(2**63), 2**63 - 1
# Rounding of lengths and angles never drops a member: ranges are widened by this.
_SLACK = 1e-6


def matrix(vectors: pa.Array | pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """floor(256 x) of each component; shorter vectors end in zeros, longer ones at `width`."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0)) if width is None else width
    row = np.repeat(np.arange(len(sizes)), sizes)
    column = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = column < width
    out = np.zeros((len(sizes), width))
    out[row[inside], column[inside]] = values[inside]
    return np.floor(out * SCALE)


def _lengths(rows: np.ndarray) -> np.ndarray:
    """Euclidean lengths of rows of whole numbers, without overflow of the squares."""
    top = np.maximum(np.abs(rows).max(axis=1, initial=0), 1)
    return top * np.sqrt(((rows / top[:, None]) ** 2).sum(axis=1))


def _units(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return rows / np.where(lengths > 0, lengths, 1)[:, None]


class Bucket:
    """Vectors of similar length with a sorted list of each coordinate."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, lengths: np.ndarray):
        self.rows, self.ids, self.labels = rows, ids, labels
        self.longest, self.shortest = lengths.max(), lengths.min()
        self.units = _units(rows, lengths)
        self.by_label = np.argsort(labels, kind="stable")
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, axis: int) -> tuple[np.ndarray, np.ndarray]:
        if axis not in self._lists:
            order = np.argsort(self.units[:, axis], kind="stable")
            self._lists[axis] = order, self.units[order, axis]
        return self._lists[axis]


def buckets(rows: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> Iterator[Bucket]:
    """The longest vectors first."""
    lengths = _lengths(rows)
    order = np.argsort(-lengths, kind="stable")
    start, n = 0, len(order)
    while start < n:
        narrow = np.searchsorted(-lengths[order], -NARROW * lengths[order[start]], "right")
        end = min(n, start + BUCKET, max(int(narrow), start + FEWEST))
        own = order[start:end]
        yield Bucket(rows[own], ids[own], labels[own], lengths[own])
        start = end


class Anchors:
    """A block of anchors: whole components, lengths, and the axes in which each is largest."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels, self.rows = ids, labels, rows
        self.lengths = _lengths(rows)
        self.units = _units(rows, self.lengths)
        few = min(FOCUS, rows.shape[1])
        self.focus = np.argsort(-np.abs(self.units), axis=1, kind="stable")[:, :few]
        self.largest = np.abs(rows).max(initial=0)
        self.longest = self.lengths.max(initial=0)
        self._small: np.ndarray | None = None

    def least_cosine(self, need: np.ndarray, bucket: Bucket) -> np.ndarray:
        """The cosine that a member of the bucket has at least if its score reaches `need`."""
        by = np.where(need >= 0, bucket.longest, bucket.shortest) * self.lengths
        with np.errstate(divide="ignore", invalid="ignore"):
            least = need / by
        # Without length all scores are 0.
        least = np.where(by > 0, least, np.where(need > 0, np.inf, -np.inf))
        return np.where(np.isnan(least), -np.inf, least - _SLACK * (1 + np.abs(least)))

    def _ranges(self, bucket: Bucket, some: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, ...]:
        """For each focus of some anchors: its axis and value, the range of a member's value, and the run in the list."""
        turn = np.arccos(np.clip(least, -1, 1))
        focus = self.focus[some]
        at = np.take_along_axis(self.units[some], focus, axis=1)
        angle = np.arccos(np.clip(at, -1, 1))
        low = np.cos(np.minimum(np.pi, angle + turn[:, None])) - _SLACK
        high = np.cos(np.maximum(0, angle - turn[:, None])) + _SLACK
        start = np.zeros(focus.shape, np.int64)
        end = np.full(focus.shape, len(bucket.ids))
        for axis in np.unique(focus):
            here = focus == axis
            values = bucket.sorted_list(axis)[1]
            start[here] = np.searchsorted(values, low[here], "left")
            end[here] = np.searchsorted(values, high[here], "right")
        return focus, at, low, high, start, end

    def members(self, bucket: Bucket, need: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of anchor and member that lie in all ranges, some at a time."""
        least = self.least_cosine(need, bucket)
        alive = np.flatnonzero(least <= 1)
        if not len(alive):
            return
        focus, at, low, high, start, end = self._ranges(bucket, alive, least[alive])
        rest = np.sqrt(np.maximum(0, 1 - (at**2).sum(axis=1)))
        if focus.shape[1]:
            # The shortest run gives the members; the others are looked at for these.
            best = np.argmin(end - start, axis=1)
            first = np.take_along_axis(start, best[:, None], axis=1)[:, 0]
            count = np.take_along_axis(end, best[:, None], axis=1)[:, 0] - first
            axis = np.take_along_axis(focus, best[:, None], axis=1)[:, 0]
        else:
            first, axis = np.zeros(len(alive), np.int64), np.zeros(len(alive), np.int64)
            count = np.full(len(alive), len(bucket.ids))
        upto = np.cumsum(count)
        done = 0
        while done < len(alive):
            base = upto[done - 1] if done else 0
            stop = max(done + 1, int(np.searchsorted(upto, base + PAIRS, "right")))
            some = slice(done, stop)
            who = np.repeat(np.arange(done, stop), count[some])
            place = np.arange(len(who)) - np.repeat(upto[some] - count[some] - base, count[some])
            place += np.repeat(first[some], count[some])
            if focus.shape[1]:
                member = np.empty(len(who), np.int64)
                for number in np.unique(axis[some]):
                    here = axis[who] == number
                    member[here] = bucket.sorted_list(number)[0][place[here]]
            else:
                member = place
            # What is left of a member of length one bounds the rest of its cosine.
            dot, left = np.zeros(len(who)), np.ones(len(who))
            for k in range(focus.shape[1]):
                value = bucket.units[member, focus[who, k]]
                inside = (value >= low[who, k]) & (value <= high[who, k])
                dot += at[who, k] * value
                left -= value**2
                who, member, dot, left = who[inside], member[inside], dot[inside], left[inside]
            inside = dot + rest[who] * np.sqrt(np.maximum(left, 0)) >= least[alive[who]] - _SLACK
            yield alive[who[inside]], member[inside]
            done = stop

    def scores(self, bucket: Bucket, who: np.ndarray, member: np.ndarray) -> np.ndarray:
        """Exact inner products of pairs in the order of anchors; what does not fit a long stops at its ends."""
        most = self.largest * np.abs(bucket.rows).max(initial=0) * max(1, self.rows.shape[1])
        if most < 2**53:
            first, last = (who[0], who[-1] + 1) if len(who) else (0, 0)
            if 4 * len(who) >= (last - first) * len(bucket.ids):
                # Most pairs of these anchors are left: one product is cheaper than picking rows.
                whole = self.rows[first:last] @ bucket.rows.T
                return whole[who - first, member].astype(np.int64)
            out = np.einsum("ij,ij->i", self.rows[who], bucket.rows[member])
            return out.astype(np.int64)
        whole_a = {i: [int(x) for x in self.rows[i]] for i in np.unique(who).tolist()}
        whole_b = {j: [int(x) for x in bucket.rows[j]] for j in np.unique(member).tolist()}
        found = [
            sum(map(int.__mul__, whole_a[i], whole_b[j]))
            for i, j in zip(who.tolist(), member.tolist(), strict=True)
        ]
        return np.array([max(_LEAST, min(_LARGEST, x)) for x in found], np.int64)

    def _leave_much(self, bucket: Bucket, alive: np.ndarray, least: np.ndarray) -> bool:
        """Whether the shortest runs of a few anchors hold much of the bucket."""
        some = alive[:: -(-len(alive) // SAMPLE)]
        start, end = self._ranges(bucket, some, least[some])[4:]
        shortest = (end - start).min(axis=1, initial=len(bucket.ids))
        return shortest.sum() >= MUCH * len(some) * len(bucket.ids)

    def _products(
        self, bucket: Bucket, need: np.ndarray, alive: np.ndarray, own: bool
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        # All sums on the way stay below the product of the lengths, and whole numbers below 2^24 are exact in four bytes.
        rows, cols = self.rows, bucket.rows
        if max(1, self.longest) * max(1, bucket.longest) < 0.99 * 2**24:
            if self._small is None:
                self._small = rows.astype(np.float32)
            rows, cols, need = self._small, cols.astype(np.float32), need.astype(np.float32)
        pairs = [(alive, np.arange(len(bucket.ids)))]
        if own:
            mine = alive[np.argsort(self.labels[alive], kind="stable")]
            shared = np.intersect1d(self.labels[mine], bucket.labels)
            a, b = self.labels[mine], bucket.labels[bucket.by_label]
            ends = [np.searchsorted(x, shared, side) for x in (a, b) for side in ("left", "right")]
            pairs = [(mine[i:j], bucket.by_label[k:m]) for i, j, k, m in zip(*ends, strict=True)]
        for mine, theirs in pairs:
            members = cols[theirs].T
            for at in range(0, len(mine), ROWS):
                some = mine[at : at + ROWS]
                whole = rows[some] @ members
                hit = np.flatnonzero(whole >= need[some, None])
                who, member = np.divmod(hit, len(theirs))
                yield some[who], theirs[member], whole.ravel()[hit].astype(np.int64)

    def reaching(
        self, bucket: Bucket, need: np.ndarray, own: bool = False
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Anchor, member and score of all pairs that reach `need`, and maybe others, some at a time; with `own` at
        least those whose labels are equal."""
        least = self.least_cosine(need, bucket)
        alive = np.flatnonzero(least <= 1)
        if not len(alive):
            return
        exact = max(1, self.longest) * max(1, bucket.longest) < 0.99 * 2**53
        if exact and self._leave_much(bucket, alive, least):
            yield from self._products(bucket, need, alive, own)
            return
        for who, member in self.members(bucket, need):
            if own:
                equal = self.labels[who] == bucket.labels[member]
                who, member = who[equal], member[equal]
            yield who, member, self.scores(bucket, who, member)


class Best:
    """The highest scores of each query so far; ties go to the smaller id."""

    def __init__(self, queries: int, most: int):
        self.most = most
        self.query = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.bar = np.full(queries, _LEAST)
        self._new: list[tuple[np.ndarray, ...]] = []

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Rows are sorted once they are as many as those held, so that each is sorted a few times only."""
        self._new.append((query, score, ids))
        if sum(len(new[0]) for new in self._new) > max(PAIRS, len(self.query)):
            self.settle()

    def settle(self) -> None:
        rows = zip((self.query, self.score, self.id), *self._new, strict=True)
        query, score, ids = map(np.concatenate, rows)
        self._new = []
        # The bit complement orders longs downwards without overflow.
        order = np.lexsort((ids, ~score, query))
        query, score, ids = query[order], score[order], ids[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        keep = rank < self.most
        self.query, self.score, self.id = query[keep], score[keep], ids[keep]
        last = rank == self.most - 1
        self.bar[query[last]] = score[last]

    def batch(self) -> pa.RecordBatch:
        self.settle()
        columns = {"query": self.query, "vec_id": self.id, "score": self.score}
        return pa.RecordBatch.from_pydict(columns)


_FOUND = "query long, vec_id long, score long"
_RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
    "negative_score long"
)


def _buckets_of(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[Bucket]:
    """A task's first rows come a few at a time: until the best of them are known, all others would be kept."""
    most = FEWEST
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            some = batch.slice(start, most)
            rows = matrix(some.column("embedding"), width)
            ids = some.column("vec_id").to_numpy()
            yield from buckets(rows, ids, some.column("label").to_numpy())
            start += some.num_rows
            most *= 2


def _positives(anchors: Anchors, most: int):
    """A task's best rows of the anchor's own label, the anchor's id left out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(anchors.ids), most)
        for bucket in _buckets_of(batches, anchors.rows.shape[1]):
            need = np.where(best.bar == _LEAST, -np.inf, best.bar)
            for who, member, score in anchors.reaching(bucket, need, own=True):
                fit = (anchors.ids[who] != bucket.ids[member]) & (score >= best.bar[who])
                best.add(who[fit], score[fit], bucket.ids[member[fit]])
        yield best.batch()

    return run


def _negatives(anchors: Anchors, owner: np.ndarray, top: np.ndarray, bottom: np.ndarray, most: int):
    """A task's best rows of other labels whose score lies between `bottom` and `top` of a query.

    Queries of one anchor, `owner`, stand together; a member is looked up and compared once
    for all of them.
    """
    first = np.searchsorted(owner, np.arange(len(anchors.ids)))
    count = np.searchsorted(owner, np.arange(len(anchors.ids)), "right") - first

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(owner), most)
        for bucket in _buckets_of(batches, anchors.rows.shape[1]):
            need = np.full(len(anchors.ids), np.inf)
            np.minimum.at(need, owner, np.maximum(best.bar, bottom))
            for who, member, score in anchors.reaching(bucket, need):
                other = anchors.labels[who] != bucket.labels[member]
                who, member, score = who[other], member[other], score[other]
                for k in range(count.max(initial=0)):
                    has = count[who] > k
                    query, value, row = first[who[has]] + k, score[has], member[has]
                    fit = (value <= top[query]) & (value >= bottom[query])
                    fit &= value >= best.bar[query]
                    best.add(query[fit], value[fit], bucket.ids[row[fit]])
        yield best.batch()

    return run


def _first(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block_bytes: int = ANCHOR_BYTES,
) -> DataFrame:
    """Rows of other labels that score almost as high with an anchor as its positives.

    Both tables hold `vec_id, embedding, label`; components become floor(256 x), a score is the inner
    product. An anchor's positives are the first `positives` rows of its label with another
    id, higher scores first, ties by the smaller id. For each of them come the first
    `negatives` rows of other labels, in the same order, with `low` to `high` percent of its
    score: `anchor_id, positive_id, rank` (int, from 1), `negative_id, positive_score,
    negative_score`. Positives below zero have none.

    Anchors are answered in blocks of `block_bytes` of components, which go to the tasks; two scans
    of the vectors, which are not shuffled, answer a block, and its result is written. What a
    task returns, and what the driver holds of a block's positives, is bounded by the block.

    Rows with a null id or label, a null vector, or a null or non-finite component take no
    part. An anchor's own are all rows with its id; equal anchor rows are answered once,
    repeated vectors count each. Vectors of different length are compared as if the shorter
    ended in zeros. Scores beyond a long stop at its ends. Extra columns are ignored.
    """
    usable = (
        "vec_id is not null and label is not null and embedding is not null and not "
        "exists(embedding, x -> x is null or isnan(x) or abs(x) = double('Infinity'))"
    )

    def plain(table: DataFrame) -> DataFrame:
        return table.select(
            table["vec_id"].cast("long").alias("vec_id"),
            table["embedding"].cast("array<double>").alias("embedding"),
            table["label"].cast("long").alias("label"),
        ).where(usable)

    spark = vectors.sparkSession
    rows = plain(vectors)
    asked = stored(plain(anchors).distinct(), "anchors")
    size = asked.agg(
        F.count("*").alias("n"), F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("width")
    ).first()
    blocks = -(-size["n"] * max(1, size["width"]) * 8 // block_bytes)
    of = F.pmod(F.xxhash64("vec_id", "embedding", "label"), F.lit(max(1, blocks)))
    path = f"{shared_folder(spark, 'llm')}/{uuid.uuid4().hex}/negatives"
    spark.createDataFrame([], _RESULT).write.parquet(path)
    for number in range(blocks):
        own = asked.where(of == number).orderBy("vec_id", "label", "embedding").toArrow()
        if not own.num_rows:
            continue
        block = Anchors(
            own.column("vec_id").to_numpy(),
            own.column("label").to_numpy(),
            matrix(own.column("embedding")),
        )
        found = rows.mapInArrow(_positives(block, positives), _FOUND)
        # At most `positives` rows an anchor of the block; below zero there are no negatives.
        near = _first(found, positives).where("score >= 0").orderBy("query", "rank").toArrow()
        owner, score = near.column("query").to_numpy(), near.column("score").to_numpy()
        if not len(owner):
            continue
        bottom = np.array([-(-low * s // 100) for s in score.tolist()], np.int64)
        top = np.array([high * s // 100 for s in score.tolist()], np.int64)
        found = rows.mapInArrow(_negatives(block, owner, top, bottom, negatives), _FOUND)
        pairs = spark.createDataFrame(
            pa.table(
                {
                    "query": np.arange(len(owner)),
                    "anchor_id": block.ids[owner],
                    "positive_id": near.column("vec_id"),
                    "positive_score": score,
                }
            )
        )
        result = _first(found, negatives).join(pairs, "query")
        result.select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(path)
    return spark.read.schema(_RESULT).parquet(path)
