"""Packing against encoding and placing one document at a time."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidegauge.llm import packing

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def encode():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def check(rows, texts, encode, capacity=1024, end=2):
    """Every document's pieces, and sequences without gaps or overlaps; returns how many."""
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == set(texts)
    for doc_id, text in texts.items():
        ids = [*encode(text), end]
        own = sorted(pieces[doc_id], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert [r["start"] for r in own] == [sum(r["length"] for r in own[:i]) for i in range(len(own))]
        assert sum(r["length"] for r in own) == len(ids)
        assert len(own) == -(-len(ids) // capacity)
        assert all(r["length"] == capacity for r in own[1:])
        for r in own:
            part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(sequences) == list(range(len(sequences)))
    return len(sequences)


def one_by_one(lengths, capacity):
    """The method with real pieces: match the long ones, then the tightest gap for each short one."""
    large = sorted(n for n in lengths if 3 * n > capacity)
    gaps = []
    while large:
        a = large.pop()
        fits = [n for n in large if n <= capacity - a]
        b = max(fits, default=0)
        if b:
            large.remove(b)
        gaps.append(capacity - a - b)
    for n in sorted((n for n in lengths if 3 * n <= capacity), reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is None:
            gaps.append(capacity - n)
        else:
            gaps.remove(fit)
            gaps.append(fit - n)
    return len(gaps)


def test_plan_equals_packing_one_by_one():
    rng = random.Random(1)
    for capacity in (7, 30, 100):
        for _ in range(150):
            kind = rng.random()
            top = capacity if kind < 0.5 else max(1, capacity // 2)
            lengths = [rng.randint(1, top) for _ in range(rng.randint(0, 60))]
            counts = {n: lengths.count(n) for n in lengths}
            runs = packing.plan(counts, capacity)
            filled, used = {}, dict.fromkeys(counts, 0)
            ends = {}
            for length, first, each, sequence, offset in runs:
                assert first == ends.get(length, 0)
                later = [r[1] for r in runs if r[0] == length and r[1] > first]
                upto = min(later, default=counts[length])
                ends[length] = upto
                for number in range(upto - first):
                    place = sequence + number // each
                    at = offset + number % each * length
                    filled.setdefault(place, []).append((at, length))
                    used[length] += 1
            assert used == counts
            for held in filled.values():
                at = 0
                for offset, length in sorted(held):
                    assert offset == at
                    at += length
                assert at <= capacity
            assert len(filled) == one_by_one(lengths, capacity)
            assert sorted(filled) == list(range(len(filled)))


def test_plan_is_small_and_tight():
    """A billion pieces: the plan depends on the lengths, and little room is left."""
    rng = random.Random(2)
    counts = {n: rng.randint(1, 2_000_000) for n in range(1, 1025)}
    runs = packing.plan(counts)
    sequences = max(r[3] for r in runs)
    least = sum(n * c for n, c in counts.items()) / 1024
    assert len(runs) < 20_000 and sequences < 1.1 * least


def test_packing_of_the_given_documents(spark, encode):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = packing.pack(docs).collect()
    sequences = check(found, texts, encode)
    assert sequences == one_by_one([r["length"] for r in found], 1024)
    again = {tuple(r) for r in packing.pack(docs.repartition(5)).select("doc_id", "piece", "ids_crc32").collect()}
    assert again == {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in found}


def test_small_capacity_and_ids(spark, documents, encode):
    docs = documents([(i, "word " * i) for i in range(60)])
    found = packing.pack(docs, capacity=16, end=50256, ids=True).collect()
    check(found, {i: "word " * i for i in range(60)}, encode, 16, 50256)
    for r in found:
        whole = [*encode("word " * r["doc_id"]), 50256]
        got = np.frombuffer(r["ids"], "<u4").tolist()
        assert got == whole[r["start"] : r["start"] + r["length"]]


def test_odd_documents(spark, documents, odd, encode):
    found = packing.pack(odd).collect()
    assert len({(r["doc_id"], r["piece"], r["sequence_id"], r["offset"]) for r in found}) == len(found)
    assert sum(r["length"] == 1 for r in found if r["doc_id"] in (1, 2)) == 2
    assert packing.pack(odd.where("false")).count() == 0
    texts = {
        1: "\n" * 400_000 + "x",
        2: ("naïve résumé word's 12 !! \n" * 60_000),
        3: "x" * 1_200_000,
        4: "<|endoftext|> is text",
        5: "日本語" * 1000,
        6: None,
    }
    check(packing.pack(documents(list(texts.items()))).collect(), texts, encode)


def test_seams_do_not_change_ids(monkeypatch, encode):
    with open(public_tokenizers.path(packing.VOCABULARY), "rb") as file:
        encoder = packing.Encoder(file.read())
    monkeypatch.setattr(packing, "_LONG", 7)
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice(["a", "Be", " ", "  ", "'s", "'", "1", "é", "\n", "!", " word", "日"]) for _ in range(40))
        assert encoder.ids(text).tolist() == encode(text)
