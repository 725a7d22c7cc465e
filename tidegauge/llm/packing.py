"""Best-fit packing of documents into sequences of a fixed number of tokens.

Lengths are whole numbers up to the capacity, so a packing is a plan over the histogram of
lengths, whose size does not depend on the data: which lengths share a sequence, and how many
such sequences there are. Documents above one third of the capacity come first: at most two of them
fit one sequence, and the longest is matched with the longest that still fits. Shorter
ones then go, long ones first, into the smallest gap that takes them. Pieces are numbered
among those of their length by counts of each task, and look up their place by that number.
"""

from __future__ import annotations

import bisect
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import all_pieces, stored

CAPACITY = 1024
END = 2
VOCABULARY = "byte_bpe_50k.json"
# Fixed value: how a byte-level vocabulary of this kind takes text apart before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Longer texts are encoded in parts. After a letter, a blank and a letter start a new part of the
# pattern whatever stands around them.
_LONG = 1 << 20
_SEAM = regex.compile(r"\p{L}(?= \p{L})")
# Numbers within a length take this many bits of a lookup key.
_NUMBER = 44


class Encoder:
    """Token ids of a byte-level vocabulary file, as the library `tokenizers` gives them.

    Texts go through the faster `tiktoken` with the same vocabulary, and through `tokenizers` where
    that one cannot take them (over some hundred thousand blanks in a row).
    """

    def __init__(self, vocabulary: bytes):
        import tiktoken
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_buffer(vocabulary)
        self.plain.encode_special_tokens = True
        special = {t.content for t in self.plain.get_added_tokens_decoder().values()}
        # Bytes that print stand for themselves, the others for code points from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {
            bytes(byte[c] for c in token): number
            for token, number in self.plain.get_vocab().items()
            if token not in special
        }
        self.fast = tiktoken.Encoding(
            "vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def _part(self, text: str) -> np.ndarray:
        try:
            return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), "<u4")
        except ValueError:
            return np.array(self.plain.encode(text, add_special_tokens=False).ids, "<u4")

    def ids(self, text: str) -> np.ndarray:
        if len(text) <= _LONG:
            return self._part(text)
        parts, start = [], 0
        while len(text) - start > _LONG:
            seam = _SEAM.search(text, start + _LONG)
            if seam is None:
                break
            parts.append(self._part(text[start : seam.end()]))
            start = seam.end()
        return np.concatenate([*parts, self._part(text[start:])])


_encoders: dict[bytes, Encoder] = {}


def _encoder(vocabulary: bytes) -> Encoder:
    """One encoder a worker process."""
    name = hashlib.sha256(vocabulary).digest()
    if name not in _encoders:
        _encoders[name] = Encoder(vocabulary)
    return _encoders[name]


def cuts(tokens: int, capacity: int) -> list[int]:
    """Where the pieces of a document start: full ones, after a first one that takes the rest."""
    return [0, *range(tokens % capacity or capacity, tokens, capacity)]


def _tokenised(vocabulary: bytes, capacity: int, end: int, keep: bool, schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder = TaskContext.get().partitionId(), _encoder(vocabulary)
        last = np.array([end], "<u4")
        seen: dict[int, int] = {}
        for batch in all_pieces(batches, "text"):
            rows = {name: [] for name in schema.names}
            size = 0
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.concatenate([encoder.ids(text or ""), last])
                starts = cuts(len(ids), capacity)
                for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    number = seen.get(b - a, 0)
                    seen[b - a] = number + 1
                    own = ids[a:b].tobytes()
                    values = [doc_id, piece, a, b - a, zlib.crc32(own), part, number]
                    for name, value in zip(rows, values + [own] * keep, strict=True):
                        rows[name].append(value)
                    size += len(own) * keep
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pydict(rows, schema)
                        rows, size = {name: [] for name in schema.names}, 0
            yield pa.RecordBatch.from_pydict(rows, schema)

    return run


class _Gaps:
    """Runs of sequences by the room that is left in each."""

    def __init__(self):
        self.sizes: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def add(self, gap: int, first: int, count: int) -> None:
        if not gap or not count:
            return
        if gap not in self.runs:
            bisect.insort(self.sizes, gap)
            self.runs[gap] = []
        self.runs[gap].append((first, count))

    def take(self, least: int) -> tuple[int, int, int] | None:
        """A run with the smallest gap of that size at least."""
        at = bisect.bisect_left(self.sizes, least)
        if at == len(self.sizes):
            return None
        gap = self.sizes[at]
        first, count = self.runs[gap].pop()
        if not self.runs[gap]:
            del self.runs[gap], self.sizes[at]
        return gap, first, count


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Places for so many pieces of each length, as runs.

    A run is `(length, first, each, sequence, offset)`: pieces of that length, numbered from `first`
    on up to the next run, fill sequences from `sequence` on with `each` pieces, one behind
    the other from `offset` on. The number of runs is bounded by the capacity alone.
    """
    left = {n: c for n, c in counts.items() if c}
    used = dict.fromkeys(left, 0)
    gaps, runs, sequences = _Gaps(), [], 0

    def put(length: int, each: int, count: int, sequence: int, offset: int) -> None:
        runs.append((length, used[length], each, sequence, offset))
        used[length] += each * count
        left[length] -= each * count

    # At most two pieces above one third of the capacity share a sequence.
    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        at = bisect.bisect_right(large, capacity - a) - 1
        b = large[at] if at >= 0 else None
        if b == a and left[a] == 1:
            b = large[at - 1] if at else None
        if b is None:
            count = left[a]
            put(a, 1, count, sequences, 0)
            gaps.add(capacity - a, sequences, count)
        elif b == a:
            count = left[a] // 2
            put(a, 2, count, sequences, 0)
            gaps.add(capacity - 2 * a, sequences, count)
        else:
            count = min(left[a], left[b])
            put(a, 1, count, sequences, 0)
            put(b, 1, count, sequences, a)
            gaps.add(capacity - a - b, sequences, count)
        sequences += count
        large = [n for n in large if left[n]]
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            found = gaps.take(length)
            gap, first, count = found or (capacity, sequences, -(-left[length] // (capacity // length)))
            each = gap // length
            full = min(count, left[length] // each)
            offset = capacity - gap
            if full:
                put(length, each, full, first, offset)
                gaps.add(gap - each * length, first, full)
            rest = left[length] if full < count else 0
            if rest:
                put(length, rest, 1, first + full, offset)
                gaps.add(gap - rest * length, first + full, 1)
            if found:
                gaps.add(gap, first + full + (rest > 0), count - full - (rest > 0))
            else:
                sequences += count
    return runs


def _placed(runs: list[tuple[int, int, int, int, int]], schema: pa.Schema):
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    keys = (table[:, 0] << _NUMBER) + table[:, 1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            at = table[np.searchsorted(keys, (length << _NUMBER) + number, "right") - 1]
            by = number - at[:, 1]
            columns = {n: batch.column(n) for n in batch.schema.names if n != "number"}
            columns["sequence_id"] = pa.array(at[:, 3] + by // at[:, 2])
            columns["offset"] = pa.array(at[:, 4] + by % at[:, 2] * length)
            yield pa.RecordBatch.from_pydict(columns, schema)

    return run


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    end: int = END,
    ids: bool = False,
) -> DataFrame:
    """Where the token ids of each document stand in sequences of at most `capacity` ids.

    A document (`doc_id, text`) is the ids of its text without special tokens, then `end`. Longer
    ones than `capacity` are cut into pieces of that many ids, the first piece takes the rest.
    `vocabulary` is the path of a byte-level file of the library `tokenizers`; it is read on
    the driver and sent to the tasks.

    Returns a row for each piece: `doc_id, piece` (int, from 0), `start` (ids of the document before
    it), `length, ids_crc32` (of little-endian unsigned 32-bit ids), `sequence_id` (from 0
    without gaps), `offset` in the sequence; with `ids` also those bytes. Sequences are
    filled from 0 on without gaps. Only the histogram of lengths, at most `capacity` numbers,
    reaches the driver.

    Null and empty texts are `end` alone. Repeated rows and ids are documents of their own. Texts
    of any length are encoded in parts of about a million characters. Extra columns are
    ignored; an empty table gives no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path(VOCABULARY)
    with open(vocabulary, "rb") as file:
        held = file.read()
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    own = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    more = ", ids binary" if ids else ""
    ddl = f"{own}, part int, number long{more}"

    def arrow(text: str) -> pa.Schema:
        return to_arrow_schema(StructType.fromDDL(text))

    pieces = stored(
        rows.mapInArrow(_tokenised(held, capacity, end, ids, arrow(ddl)), ddl), "pieces"
    )
    counts = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "counts")
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    runs = plan({r["length"]: r["n"] for r in histogram}, capacity)
    # Pieces of a length in earlier tasks: one row a task and length.
    earlier = Window.partitionBy("length").orderBy("part")
    before = F.sum("n").over(earlier) - F.col("n")
    numbered = pieces.join(
        counts.select("part", "length", before.alias("before")), ["part", "length"]
    )
    names = [field.split(" ")[0] for field in (own + more).split(", ")]
    numbered = numbered.select(*names, (F.col("before") + F.col("number")).alias("number"))
    ddl = f"{own}{more}, sequence_id long, offset long"
    return numbered.mapInArrow(_placed(runs, arrow(ddl)), ddl)
