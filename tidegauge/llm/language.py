"""Language identification by rank-order n-gram profiles."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.common import pieces, stored

# Grams in a language's profile and in a document's.
PROFILE = 400
# A gram is up to three characters of 21 bits, first character highest; 1 stands for
# the edge of a word, 0 for no character.
_EDGE = 1
_BITS = 21
_FLUSH = 400_000
# Bytes of text that are taken apart at once; a gram's arrays take some hundred bytes a letter.
_PIECE = 1 << 20


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _grams(values: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grams of all texts as numbers, their document, and the key of each number.

    Numbers are dense in the characters of these texts and sort as the keys do.
    """
    lowered = ["\x00" + (value or "").lower() for value in values]
    code = np.frombuffer("".join(lowered).encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(lowered), dtype=np.int32), [len(x) for x in lowered])
    code = np.where(_letters()[code], code, _EDGE).astype(np.uint32)
    first = np.r_[True, owner[1:] != owner[:-1]]
    keep = first | (code != _EDGE) | (np.r_[np.uint32(_EDGE), code[:-1]] != _EDGE)
    code, owner = code[keep], owner[keep]
    alphabet = np.unique(np.r_[np.uint32(0), np.uint32(_EDGE), code])
    base = len(alphabet)
    small = np.int32 if base**3 < 2**31 else np.int64
    dense = np.searchsorted(alphabet, np.r_[code, np.uint32(_EDGE)]).astype(small)
    at = np.flatnonzero(code != _EDGE)
    here, left, right = dense[at], dense[at - 1], dense[at + 1]
    ends = np.flatnonzero(right == 1)
    square = base * base
    number = np.concatenate(
        [
            here * square,
            left * square + here * base,
            here[ends] * square + base,
            left * square + here * base + right,
        ]
    )
    own = owner[at]
    return number, np.concatenate([own, own, own[ends], own]), alphabet.astype(np.int64)


def _keys(number: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    base = len(alphabet)
    number = number.astype(np.int64)
    first, rest = np.divmod(number, base * base)
    second, third = np.divmod(rest, base)
    return (alphabet[first] << 2 * _BITS) | (alphabet[second] << _BITS) | alphabet[third]


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`text, lang` to partial counts `lang, gram, n`."""
    counts: dict[str, dict[int, int]] = {}
    held = 0

    def flush():
        for lang, found in counts.items():
            if found:
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([lang] * len(found)),
                        "gram": pa.array(list(found.keys()), pa.int64()),
                        "n": pa.array(list(found.values()), pa.int64()),
                    }
                )
        counts.clear()

    for batch in batches:
        for piece in pieces(batch, "text", _PIECE):
            langs = np.array(piece.column("lang").to_pylist(), dtype=object)
            number, owner, alphabet = _grams(piece.column("text").to_pylist())
            names, of = np.unique(langs, return_inverse=True)
            own = of[owner]
            for i, lang in enumerate(names):
                found, n = np.unique(number[own == i], return_counts=True)
                into = counts.setdefault(lang, {})
                before = len(into)
                for gram, times in zip(_keys(found, alphabet).tolist(), n.tolist(), strict=True):
                    into[gram] = into.get(gram, 0) + times
                held += len(into) - before
            if held > _FLUSH:
                yield from flush()
                held = 0
    yield from flush()


def profiles(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE):
    """The `size` most frequent grams of each language: `lang, gram, rank` (from 0).

    Counts cover every row whose language is not null. Ties go to the smaller gram.
    """
    rows = docs.select(docs[text].alias("text"), docs[lang].alias("lang")).where(
        "text is not null and lang is not null"
    )
    counts = (
        rows.mapInArrow(_count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # Spark takes such a filter as a limit for each task, ahead of the shuffle by language.
    first = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)
    return first.select("lang", "gram", (F.col("place") - 1).alias("rank"))


def _predict(known: dict[str, tuple[np.ndarray, np.ndarray]], size: int):
    langs = sorted(known)

    def per_piece(values: list[str | None]) -> tuple[list[str], list[float]]:
        number, owner, alphabet = _grams(values)
        order = np.argsort(owner, kind="stable")
        number = number[order]
        ends = np.searchsorted(owner[order], np.arange(len(values) + 1))
        top, owners, ranks = [], [], []
        for i in range(len(values)):
            own = np.sort(number[ends[i] : ends[i + 1]])
            if not len(own):
                continue
            cut = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            times = np.diff(np.r_[cut, len(own)])
            best = np.argsort(-times, kind="stable")[:size]
            top.append(own[cut[best]])
            owners.append(np.full(len(best), i))
            ranks.append(np.arange(len(best)))
        best_lang, score = ["und"] * len(values), [0.0] * len(values)
        if not top or not langs:
            return best_lang, score
        keys = _keys(np.concatenate(top), alphabet)
        own, rank = np.concatenate(owners), np.concatenate(ranks)
        n = np.bincount(own, minlength=len(values))
        away = np.empty((len(langs), len(values)))
        for j, lang in enumerate(langs):
            grams, places = known[lang]
            at = np.minimum(np.searchsorted(grams, keys), len(grams) - 1)
            gap = np.where(grams[at] == keys, np.abs(places[at] - rank), size)
            away[j] = np.bincount(own, np.minimum(gap, size), len(values))
        nearest = away.argmin(axis=0)
        for i in np.flatnonzero(n):
            best_lang[i] = langs[nearest[i]]
            score[i] = float(1 - away[nearest[i], i] / (n[i] * size))
        return best_lang, score

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", _PIECE):
                best, score = per_piece(piece.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("row"), pa.array(best, pa.string()), pa.array(score, pa.float64())],
                    ["row", "lang_pred", "score"],
                )

    return run


def _tables(learned: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Grams in order, and their ranks, of each language; `PROFILE` rows a language at most."""
    known: dict[str, list[tuple[int, int]]] = {}
    for row in learned.toLocalIterator():
        known.setdefault(row["lang"], []).append((row["gram"], row["rank"]))
    return {
        lang: tuple(np.array(x, np.int64) for x in zip(*sorted(pairs), strict=True))
        for lang, pairs in known.items()
    }


def identify(docs: DataFrame, learned: DataFrame, keep: list[str], text: str = "text"):
    """Predict the language of every row of `docs`.

    `learned` comes from `profiles`; it holds `PROFILE` rows a language at most, so it
    is read into the tasks' closure. A document's grams (1 to 3 letters of lower-cased
    words, word edges included) are ranked by frequency; the distance to a language
    is the sum over its first `PROFILE` grams of the difference of ranks, or `PROFILE`
    for a gram the language does not have. The nearest language wins, ties to the
    smaller name. `score` is 1 less the distance as a part of the largest possible.

    Returns `row` (a struct of the columns `keep`, so that no name can clash),
    `lang_pred` and `score`. Text that is null or has no letter, and any text while no
    language is known, gives `und` and 0.
    """
    tables = _tables(learned)
    rows = docs.select(F.struct(*(docs[c] for c in keep)).alias("row"), docs[text].alias("text"))
    schema = T.StructType(
        [rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return rows.mapInArrow(_predict(tables, PROFILE), schema)


def held_out(doc_id) -> F.Column:
    """Documents that training never sees: a fifth, and those without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    """Learn from the documents that are not held out; documents without a language go.

    A document goes if its text is null, has no letter or shares no gram with any language's profile
    (score 0). If nothing could be learned, documents with letters stay all the same.
    """
    # Written, as the profiles are looked at twice.
    learned = stored(profiles(docs.where(~held_out(docs["doc_id"]))), "profiles")
    if learned.isEmpty():
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return identify(docs, learned, docs.columns).where("lang_pred <> 'und' and score > 0").select("row.*")
