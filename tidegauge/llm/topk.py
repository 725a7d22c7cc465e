"""Exact top-k search by inner product: branch and bound over columns."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import stored

K = 10
SCALE = 1024.0
# Queries that a scan of the candidates answers at once, dimensions of a block, and
# candidates of a chunk.
QUERIES = 4096
BLOCK = 16
CHUNK = 2048
# From this part of all pairs on, survivors are followed one by one.
_SPARSE = 0.1
_LARGEST = 2**63 - 1


def _matrix(vectors: pa.Array, width: int | None = None) -> np.ndarray:
    """floor(1024 x) of each component; shorter vectors end in zeros."""
    lists = vectors.to_pylist()
    width = max(map(len, lists), default=0) if width is None else width
    out = np.zeros((len(lists), width))
    for i, values in enumerate(lists):
        values = values[:width]
        out[i, : len(values)] = values
    return np.floor(out * SCALE)


class Best:
    """The k highest scores of each query so far; equal scores go to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.query = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.bar = np.full(queries, -np.inf)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        query, score = np.r_[self.query, query], np.r_[self.score, score]
        ids = np.r_[self.id, ids]
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        first = np.searchsorted(query, query)
        keep = np.arange(len(query)) - first < self.k
        self.query, self.score, self.id = query[keep], score[keep], ids[keep]
        last = np.arange(len(query)) - first == self.k - 1
        self.bar[query[last]] = score[last]


def _survivors(
    queries: np.ndarray, chunk: np.ndarray, bar: np.ndarray, others: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs whose score reaches the query's bar, with the score.

    Both sides are columns: `queries[dimension, query]`, `chunk[dimension, candidate]`. After each
    block of dimensions the rest of a score is bounded by the product of the norms of
    what is left; pairs that cannot reach the bar any more are dropped, and once few are left
    they are compacted and followed as a list.
    """
    width = len(queries)
    rest_q = np.sqrt(np.cumsum((queries**2)[::-1], axis=0)[::-1])
    rest_c = np.sqrt(np.cumsum((chunk**2)[::-1], axis=0)[::-1])
    # Sums are whole numbers and exact; only the bound is rounded.
    up = 1 + 1e-9
    part = np.zeros((queries.shape[1], chunk.shape[1]))
    alive, at = others, 0
    while at < width:
        to = min(at + BLOCK, width)
        part += queries[at:to].T @ chunk[at:to]
        at = to
        most = part
        if at < width:
            most = part + rest_q[at][:, None] * rest_c[at][None, :] * up + 1
        alive = alive & (most >= bar[:, None])
        if alive.mean() < _SPARSE:
            break
    q, c = np.nonzero(alive)
    score = part[q, c]
    while at < width and len(q):
        to = min(at + BLOCK, width)
        for d in range(at, to):
            score = score + queries[d, q] * chunk[d, c]
        at = to
        most = score
        if at < width:
            most = score + rest_q[at, q] * rest_c[at, c] * up + 1
        live = most >= bar[q]
        q, c, score = q[live], c[live], score[live]
    return q, c, score.astype(np.int64)


def _exact(queries: np.ndarray, chunk: np.ndarray, others: np.ndarray):
    """All pairs in unbounded whole numbers, for components of any size; the ends of a long hold
    what does not fit."""
    q, c = np.nonzero(others)
    whole_q = [[int(x) for x in row] for row in queries.T]
    whole_c = [[int(x) for x in row] for row in chunk.T]
    score = [
        max(-_LARGEST - 1, min(_LARGEST, sum(map(int.__mul__, whole_q[i], whole_c[j]))))
        for i, j in zip(q.tolist(), c.tolist(), strict=True)
    ]
    return q, c, np.array(score, np.int64)


def _search(ids: np.ndarray, matrix: np.ndarray, k: int):
    """Best candidates of a partition for the queries of one block."""
    columns = np.ascontiguousarray(matrix.T)
    largest = np.abs(matrix).max(initial=0)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(ids), k)
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                piece = batch.slice(start, CHUNK)
                vec = piece.column("vec_id").to_numpy()
                chunk = np.ascontiguousarray(_matrix(piece.column("embedding"), matrix.shape[1]).T)
                others = ids[:, None] != vec[None, :]
                bound = largest * np.abs(chunk).max(initial=0) * max(1, matrix.shape[1])
                if bound < 2**53:
                    q, c, score = _survivors(columns, chunk, best.bar, others)
                else:
                    q, c, score = _exact(columns, chunk, others)
                best.add(q, score, vec[c])
        yield pa.RecordBatch.from_pydict(
            {
                "query": pa.array(best.query, pa.int64()),
                "query_id": pa.array(ids[best.query], pa.int64()),
                "vec_id": pa.array(best.id, pa.int64()),
                "score": pa.array(best.score, pa.int64()),
            }
        )

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, block: int = QUERIES) -> DataFrame:
    """The k highest inner products of each query with all other vectors.

    Both tables hold `vec_id, embedding`; components become floor(1024 x). Returns `query_id, rank`
    (from 1), `vec_id, score`; ties go to the smaller id, and a query with fewer than k others
    gets them all. Queries are answered in blocks of about `block`: a block's matrix, bounded by
    that number, goes into the tasks' closure, and one scan of the candidates, which
    are not shuffled, serves it whole. A task returns k rows a query.

    Vectors that are null or hold a null or non-finite component, and rows without an id, take
    no part. A query's own is every row with its id; repeated query rows are answered
    once, repeated candidates count each. Vectors of different length are compared as if
    the shorter ended in zeros. Scores beyond a long stop at its ends.
    """
    usable = (
        "vec_id is not null and embedding is not null and not exists(embedding, "
        "x -> x is null or isnan(x) or abs(x) = double('Infinity'))"
    )
    rows = vectors.select(
        vectors["vec_id"].cast("long").alias("vec_id"),
        vectors["embedding"].cast("array<double>").alias("embedding"),
    ).where(usable)
    asked = stored(
        queries.select(
            queries["vec_id"].cast("long").alias("vec_id"),
            queries["embedding"].cast("array<double>").alias("embedding"),
        )
        .where(usable)
        .distinct(),
        "queries",
    )
    blocks = math.ceil(asked.count() / block)
    of = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    kind = "query long, query_id long, vec_id long, score long"
    found = rows.where(F.lit(False)).select(
        F.col("vec_id").alias("query_id"),
        F.lit(0).alias("rank"),
        "vec_id",
        F.col("vec_id").alias("score"),
    )
    for number in range(blocks):
        own = asked.where(of == number).orderBy("vec_id", "embedding").toArrow()
        search = _search(own.column("vec_id").to_numpy(), _matrix(own.column("embedding")), k)
        best = (
            rows.mapInArrow(search, kind)
            .withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score")
        )
        # With many blocks, each is run by itself.
        best = stored(best, f"block{number}") if blocks > 1 else best
        found = found.unionByName(best)
    return found
