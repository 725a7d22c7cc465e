"""Every query against its SQL, or against a plain computation of the same result."""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import compare
import numpy as np
import pytest
import regex
import xxhash

import __spark_entry__ as entry
from tidegauge.llm import importance, language, vocabulary
from tidegauge.llm.sql import SQL

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    rows = entry.queries()[name](spark, DATA)
    assert compare.difference(rows, compare.connect(DATA), SQL[name]) is None


def _documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect()


class Sets:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, i):
        while self.parent[i] != i:
            i = self.parent[i]
        return i

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


def simhash(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_all_pairs(spark):
    docs = _documents(spark)
    prints = {d["doc_id"]: simhash(d["text"]) for d in docs}
    sets = Sets(prints)
    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                sets.join(a, b)
    found = entry.queries()["op4_simhash_near_dedup"](spark, DATA).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found} == {
        i: (f"{p:016x}", sets.find(i)) for i, p in prints.items()
    }


def form(line: str) -> str:
    line = regex.sub("[0-9]+", "0", regex.sub(r"[^\p{L}\p{N}]+", " ", line.lower()))
    return line.strip()


def similar_pairs(spark, forms: list[str]) -> list[tuple[str, str]]:
    """All pairs whose edit similarity is 0.8 or more. An edit takes away three runs of three letters at
    most and brings as many, so most pairs of lines are ruled out by counting those; none that counts is."""
    grams = np.zeros((len(forms), 4096), np.int16)
    for row, line in zip(grams, forms, strict=True):
        for i in range(len(line) - 2):
            row[zlib.crc32(line[i : i + 3].encode()) % 4096] += 1
    sizes = np.array([len(line) for line in forms])
    left = []
    for i in range(len(forms)):
        longer = np.maximum(sizes[:i], sizes[i])
        most = (longer * 0.2 + 1e-9).astype(int)
        able = np.flatnonzero(longer - np.minimum(sizes[:i], sizes[i]) <= most)
        apart = np.abs(grams[able] - grams[i]).sum(axis=1)
        left += [(i, int(j), int(most[j])) for j in able[apart <= 6 * most[able]]]
    lines = spark.createDataFrame(list(enumerate(forms)), "n int, line string")
    pairs = spark.createDataFrame(left, "i int, j int, most int").repartition(16)
    pairs = pairs.join(lines.selectExpr("n AS i", "line AS x"), "i").join(lines.selectExpr("n AS j", "line AS y"), "j")
    return [(r["x"], r["y"]) for r in pairs.where("levenshtein(x, y) <= most").select("x", "y").collect()]


def test_lines_equal_all_pairs(spark):
    """Every pair of lines of the given documents, compared by character edit similarity."""
    places = []
    for d in _documents(spark):
        for at, line in enumerate(re.findall(r"[^\n]+\n?|\n", d["text"] or "")):
            if regex.search(r"[\p{L}\p{N}]", line):
                places.append((d["doc_id"], at, form(line)))
    forms = sorted({f for _, _, f in places})
    sets = Sets(forms)
    fuzzy = 0
    for a, b in similar_pairs(spark, forms):
        sets.join(a, b)
        fuzzy += 1
    first, gone = set(), {d["doc_id"]: [] for d in _documents(spark)}
    for doc_id, at, line in sorted(places):
        root = sets.find(line)
        if root in first:
            gone[doc_id].append(at)
        first.add(root)
    found = entry.queries()["op10_line_dedup"](spark, DATA).collect()
    assert {r["doc_id"]: r["removed"] for r in found} == {
        i: ",".join(map(str, x)) for i, x in gone.items()
    }
    assert sum(map(len, gone.values())) > 200 and fuzzy > 20


def letter_grams(text: str) -> Counter:
    """Runs of one to three letters of words with their edges (1), as code points."""
    found = Counter()
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        codes = [ord(c) for c in word]
        whole = [1, *codes, 1]
        found.update((c, 0, 0) for c in codes)
        found.update((a, b, 0) for a, b in zip(whole, whole[1:], strict=False))
        found.update(zip(whole, whole[1:], whole[2:], strict=False))
    return found


def test_language_equals_rank_distances(spark):
    """Profiles and out-of-place distances, one document and one language at a time."""
    size = language.PROFILE
    docs = _documents(spark)
    held = {d["doc_id"]: zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0 for d in docs}
    counts = defaultdict(Counter)
    for d in docs:
        if not held[d["doc_id"]] and d["lang"] is not None and d["text"] is not None:
            counts[d["lang"]] += letter_grams(d["text"])
    ranked = lambda c: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:size]]
    known = {lang: {g: r for r, g in enumerate(ranked(c))} for lang, c in counts.items()}
    for r in entry.queries()["op1_language_id"](spark, DATA).collect():
        text = next(d["text"] for d in docs if d["doc_id"] == r["doc_id"])
        own = ranked(letter_grams(text or ""))
        away = {
            lang: sum(abs(places[g] - i) if g in places else size for i, g in enumerate(own))
            for lang, places in known.items()
        }
        best = min(away, key=lambda lang: (away[lang], lang))
        want = (best, 1 - away[best] / (len(own) * size)) if own else ("und", 0.0)
        assert (r["held_out"], r["lang_pred"]) == (held[r["doc_id"]], want[0])
        assert math.isclose(r["score"], want[1], abs_tol=1e-12)


def test_language_on_held_out_documents(spark):
    langs = {d["doc_id"]: d["lang"] for d in _documents(spark)}
    found = entry.queries()["op1_language_id"](spark, DATA).collect()
    held = [r for r in found if r["held_out"]]
    assert len(found) == len(langs) and len(held) > 20
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def test_resampling_prefers_good_documents(spark):
    found = entry.queries()["op5_quality_resampling"](spark, DATA).collect()
    good = {
        r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()
    }
    assert sum(r["selected"] for r in found) == round(len(found) * 0.5)
    assert min(r["key"] for r in found if r["selected"]) > max(
        r["key"] for r in found if not r["selected"]
    )
    mean = {
        q: [r["quality"] for r in found if good.get(r["doc_id"]) == q] for q in (0, 1)
    }
    assert sum(mean[1]) / len(mean[1]) > sum(mean[0]) / len(mean[0])


def test_resampling_equals_plain_weights(spark):
    """Word and pair buckets counted one by one, weights, noise and the largest keys."""
    size = importance.BUCKETS

    def buckets(text):
        words = (text or "").encode().lower().split()
        hashes = [vocabulary.word_hashes([w])[0] for w in words]
        found = [int(vocabulary.mixed(np.array([h], np.uint64))[0] % np.uint64(size)) for h in hashes]
        pairs = [np.array(p, np.uint64) for p in zip(hashes, hashes[1:], strict=False)]
        return found + [int(vocabulary.rolled(p, 2)[0] % np.uint64(size)) for p in pairs]

    docs = {d["doc_id"]: buckets(d["text"]) for d in _documents(spark)}
    labels = spark.read.parquet(f"{DATA}/labels.parquet").collect()
    good = {r["doc_id"] for r in labels if r["quality"] == 1 and not r["toxic"]}

    def model(ids):
        counts = Counter(b for i in ids for b in docs[i])
        total = sum(counts.values()) + size
        return [math.log((counts[b] + 1) / total) for b in range(size)]

    target, raw = model(good & set(docs)), model(docs)

    def noise(doc_id):
        first = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42)
        bits = xxhash.xxh64_intdigest(struct.pack("<i", importance.SEED), first) >> 12
        return -math.log(-math.log((bits + 0.5) / (1 << 52)))

    found = {r["doc_id"]: r for r in entry.queries()["op5_quality_resampling"](spark, DATA).collect()}
    assert set(found) == set(docs)
    keys = {}
    for doc_id, own in docs.items():
        weight = sum(target[b] - raw[b] for b in own)
        keys[doc_id] = weight + noise(doc_id)
        row = found[doc_id]
        assert row["n_grams"] == len(own)
        assert math.isclose(row["log_weight"], weight, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(row["key"], keys[doc_id], rel_tol=1e-9, abs_tol=1e-9)
        mean = weight / len(own) if own else 0
        assert math.isclose(row["quality"], 1 / (1 + math.exp(-mean)), rel_tol=1e-9)
    best = sorted(keys, key=lambda i: -keys[i])[: round(len(keys) * importance.FRACTION)]
    assert {i for i, r in found.items() if r["selected"]} == set(best)


def test_pipeline_keeps_whole_and_clean_documents(spark):
    before = {d["doc_id"]: d for d in _documents(spark)}
    rows = entry.queries()["pipeline"](spark, DATA)
    assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars", "copies"]
    after = rows.collect()
    assert len({r["doc_id"] for r in after}) == len(after) > len(before) / 2
    for r in after:
        assert 1 <= r["copies"] <= 3 and r["n_chars"] == len(r["text"])
        # Only whole lines have gone; the others stand in their order.
        kept = iter(re.findall(r"[^\n]+\n?|\n", before[r["doc_id"]]["text"]))
        assert all(line in kept for line in re.findall(r"[^\n]+\n?|\n", r["text"]))
