"""Quality selection by importance resampling over hashed n-grams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.common import all_pieces, stored, texts
from tidegauge.llm.vocabulary import mixed, rolled, split_all, within, word_hashes

BUCKETS = 10_000
# Labelled documents that the target model is fitted on, at most.
TARGETS = 20_000
FRACTION = 0.5
SEED = 17
_HISTOGRAM = 1024


def _features(values: list[bytes], buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the words and of the word pairs of all texts, A-Z as a-z, each with its text."""
    words, ends = split_all([value.lower() for value in values])
    owner = np.repeat(np.arange(len(values)), np.diff(ends))
    first = word_hashes(words)
    pairs = within(ends, 2)
    found = ((mixed(first), owner), (rolled(first, 2)[pairs], owner[pairs]))
    return [((x % np.uint64(buckets)).astype(np.int64), of) for x, of in found]


def counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """`bucket, n`: n-grams of all documents by bucket. A task sends `buckets` rows at most."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for piece in all_pieces(batches, "text"):
            for bucket, _ in _features(texts(piece.column("text")), buckets):
                total += np.bincount(bucket, minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], ["bucket", "n"]
        )

    return (
        docs.select(docs[text].alias("text"))
        .mapInArrow(run, "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
    )


def _model(table: DataFrame, buckets: int) -> np.ndarray:
    """Logarithm of each bucket's probability, one count added to each."""
    n = np.ones(buckets)
    for row in table.collect():  # one row for each bucket
        n[row["bucket"]] += row["n"]
    return np.log(n / n.sum())


def target_ids(labels: DataFrame, most: int = TARGETS) -> DataFrame:
    """Ids of documents labelled good and not toxic: all, or the `most` with the smallest hash."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null")
    return (
        good.select(F.col("doc_id").cast("long").alias("doc_id"))
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )


def weights(docs: DataFrame, ratio: np.ndarray, keep: list[str], text: str = "text") -> DataFrame:
    """`row` (a struct of `keep`), `n_grams` and `log_weight`, the sum of the n-grams' log ratios."""
    rows = docs.select(F.struct(*(docs[c] for c in keep)).alias("row"), docs[text].alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in all_pieces(batches, "text"):
            values = texts(piece.column("text"))
            n, total = np.zeros(len(values), np.int64), np.zeros(len(values))
            # A text's own n-grams are added in their order: no sum depends on its neighbours.
            for bucket, owner in _features(values, len(ratio)):
                n += np.bincount(owner, minlength=len(values))
                total += np.bincount(owner, ratio[bucket], len(values))
            yield pa.RecordBatch.from_arrays(
                [piece.column("row"), pa.array(n), pa.array(total)],
                ["row", "n_grams", "log_weight"],
            )

    schema = T.StructType(
        [
            rows.schema["row"],
            T.StructField("n_grams", T.LongType()),
            T.StructField("log_weight", T.DoubleType()),
        ]
    )
    return rows.mapInArrow(run, schema)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Standard Gumbel noise that depends on the id and the seed only."""
    bits = F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(seed)), 12).cast("double")
    uniform = (bits + 0.5) / float(1 << 52)
    return -F.log(-F.log(uniform))


def kth_largest(table: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value of a column of finite doubles, without sorting.

    A histogram of 1024 buckets between the smallest and the largest value finds the bucket it
    lies in; that bucket's own smallest and largest value bound the next histogram. The driver
    sees bucket counts only.
    """
    if k <= 0:
        return None
    value, left = F.col(column), k
    inside = table
    while True:
        ends = inside.agg(F.min(value).alias("low"), F.max(value).alias("high")).first()
        low, high = ends["low"], ends["high"]
        if low is None or low == high:
            return low
        place = F.least(
            F.floor((value - F.lit(low)) / F.lit(high - low) * _HISTOGRAM), F.lit(_HISTOGRAM - 1)
        )
        found = (
            inside.groupBy(place.alias("bucket"))
            .agg(F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
            .collect()
        )
        for row in sorted(found, key=lambda r: -r["bucket"]):
            if left <= row["n"]:
                break
            left -= row["n"]
        inside = table.where((value >= F.lit(row["low"])) & (value <= F.lit(row["high"])))


def resample(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    fraction: float = FRACTION,
    buckets: int = BUCKETS,
    most: int = TARGETS,
    seed: int = SEED,
) -> DataFrame:
    """Importance resampling of `docs` towards the labelled good documents.

    Two bags of hashed words and word pairs are fitted: the target on documents labelled good
    and not toxic (`most` of them at most, by hash of the id: the one bounded sample here), the raw
    one on all documents. A document's `log_weight` is the log of the ratio of its probabilities, `key`
    adds Gumbel noise to it, and `selected` marks the `fraction` of rows with the largest keys: a
    sample without replacement in proportion to the weights. `quality` (0 to 1) is the logistic of the
    mean log ratio of an n-gram and does not depend on length.

    One row for each row of `docs`: `doc_id, n_grams, log_weight, quality, key, selected`. Null and
    blank texts have weight 0 and quality 0.5; rows tied with the last key selected are all selected;
    without a labelled document the target is even, and an empty table gives no rows.
    """
    chosen = stored(target_ids(labels, most), "targets")
    good = docs.select(docs["doc_id"].alias("doc_id"), docs[text].alias("text"))
    # At most `most` ids.
    good = good.join(F.broadcast(chosen), "doc_id", "left_semi")
    ratio = _model(counts(good, "text", buckets), buckets) - _model(
        counts(docs, text, buckets), buckets
    )
    rows = stored(
        weights(docs, ratio, ["doc_id"], text)
        .select("row.doc_id", "n_grams", "log_weight")
        .withColumn("key", F.col("log_weight") + gumbel(F.col("doc_id"), seed)),
        "weights",
    )
    last = kth_largest(rows, "key", round(rows.count() * fraction))
    mean = F.when(F.col("n_grams") > 0, F.col("log_weight") / F.col("n_grams")).otherwise(0.0)
    return rows.select(
        "doc_id",
        "n_grams",
        "log_weight",
        (1 / (1 + F.exp(-mean))).alias("quality"),
        "key",
        (F.col("key") >= F.lit(last)).alias("selected") if last is not None else F.lit(False).alias("selected"),
    )
