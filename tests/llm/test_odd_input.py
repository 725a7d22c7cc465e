"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tidegauge.llm import (
    decontaminate,
    importance,
    language,
    license,
    lines,
    mixing,
    simhash,
    substrings,
    topk,
    warc,
)
from tidegauge.session import shared_folder

STAGES = [language.stage, lines.stage, simhash.stage, decontaminate.stage, mixing.stage]


def items(spark, rows=((1, "seven eight nine ten eleven twelve one two three four"), (2, None), (3, ""))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


@pytest.fixture(scope="module")
def folder(spark):
    path = f"{shared_folder(spark, 'tests')}/odd"
    items(spark).write.mode("overwrite").parquet(f"{path}/benchmark.parquet")
    return path


@pytest.mark.parametrize("stage", STAGES)
def test_stage_on_odd_input(spark, odd, folder, stage):
    kept = stage(spark, odd, folder)
    want = odd.columns + (["copies"] if stage is mixing.stage else [])
    assert kept.columns == want
    assert kept.count() <= odd.count()


@pytest.mark.parametrize("stage", STAGES)
def test_stage_on_empty_table(spark, odd, folder, stage):
    assert stage(spark, odd.where("false"), folder).count() == 0


def test_language_rejects_only_what_has_no_letters(spark, odd, folder):
    kept = [r["doc_id"] for r in language.stage(spark, odd, folder).collect()]
    assert sorted(kept, key=str) == sorted([4, 5, 5, 6, 6, None, 8], key=str)
    without = odd.withColumn("lang", F.lit(None).cast("string"))
    assert language.stage(spark, without, folder).count() == 7


def test_lines_stage(spark, documents, folder):
    docs = documents([(1, "a b c\nd e f\n"), (2, "d e f\n\nx y"), (3, "A B C"), (4, None), (5, "\n")])
    kept = {r["doc_id"]: r["text"] for r in lines.stage(spark, docs, folder).collect()}
    assert kept == {1: "a b c\nd e f\n", 2: "\nx y", 4: None, 5: "\n"}


def test_near_duplicates_on_odd_input(odd):
    found = simhash.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    same = {r["doc_id"]: r for r in found}
    assert same[1]["fp"] == same[2]["fp"] == same[3]["fp"] == 0
    assert {same[i]["component_id"] for i in (1, 2, 3)} == {1}


def test_simhash_stage_keeps_one_of_each_group(spark, documents, folder):
    text = "the quick brown fox jumps over the lazy dog " * 20
    docs = documents([(9, text), (3, text), (3, text), (5, "something else altogether here"), (None, text)])
    assert sorted(r["doc_id"] for r in simhash.stage(spark, docs, folder).collect()) == [3, 5]


def test_bit_sliced_comparison_finds_all_pairs():
    import numpy as np

    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [np.uint64(1) << np.uint64(int(b)) for b in rng.integers(0, 64, 6)]
    prints = np.unique(np.concatenate([base] + [base ^ f ^ g for f in flips for g in flips]))
    for radius in (1, 2, 3, 4):
        start = np.arange(len(prints)) + 1
        end = np.full(len(prints), len(prints))
        got = {
            (int(a), int(b))
            for i, j in simhash.links_within(prints, start, end, radius)
            for a, b in zip(i, j, strict=True)
        }
        want = {
            (a, b)
            for a in range(len(prints))
            for b in range(a + 1, len(prints))
            if int(prints[a] ^ prints[b]).bit_count() <= radius
        }
        assert got == want


def test_hot_bucket_is_dealt_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP", 8)
    prints = spark.range(300).select((F.col("id") * 7).alias("doc_id"), F.col("id").alias("fp"))
    found = simhash.groups(prints, 1).collect()
    assert {r["component_id"] for r in found} == {0} and len(found) == 300


def test_masks_miss_nothing():
    for make, width in ((simhash.masks, 64), (lines.masks, 60)):
        for blocks in (4, 5):
            found = [m % (1 << 64) for m in make(3, blocks)]
            for a in range(0, width, 5):
                for b in range(0, width, 7):
                    for c in range(0, width, 11):
                        assert any(not m & (1 << a | 1 << b | 1 << c) for m in found)


def test_decontamination_on_odd_input(spark, odd):
    found = {r["doc_id"]: r for r in decontaminate.decontaminate(odd, items(spark)).collect()}
    assert found[5]["n_hit"] == 20 and found[5]["item_ids"] == ["1"]
    assert found[1]["n_words"] == found[2]["n_hit"] == 0
    none = decontaminate.decontaminate(odd, items(spark).where("false")).collect()
    assert len(none) == odd.count() and not any(r["n_hit"] for r in none)


def test_short_items_are_one_window(spark, documents):
    docs = documents([(1, "x a b c y"), (2, "A, B... C"), (3, "a b"), (4, "c a b d")])
    short = items(spark, [(1, "a b c"), (2, "d"), (2, "d"), (10, "a b c")])
    found = {r["doc_id"]: (r["n_hit"], r["item_ids"]) for r in decontaminate.decontaminate(docs, short).collect()}
    assert found == {1: (3, ["1", "10"]), 2: (3, ["1", "10"]), 3: (0, []), 4: (1, ["2"])}


def test_substrings_on_odd_input(odd):
    rows = substrings.dedup_substrings(odd).collect()
    assert len(rows) == odd.count()
    removed = sorted((r["n_words"], r["n_removed"]) for r in rows if r["doc_id"] == 5)
    # Windows that start in the second and third round repeat those of the first.
    assert removed == [(36, 24), (36, 36)] and substrings.dedup_substrings(odd.where("false")).count() == 0


def test_mixing_on_odd_input(odd):
    found = mixing.mix(odd).collect()
    assert len(found) == odd.count()
    assert all(0 <= r["copies"] <= 3 for r in found)
    for source in {r["source"] for r in found}:
        own = [r for r in found if r["source"] == source]
        taken = sum(r["size"] * r["copies"] for r in own)
        assert abs(taken - own[0]["target"]) <= max(r["size"] for r in own)
    assert mixing.mix(odd.where("false")).count() == 0


def test_mixing_targets_are_shared_again(spark):
    sizes = [("a", 1), ("b", 1000), ("c", 10), (None, 0)]
    table = spark.createDataFrame(sizes, "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.targets(table).collect()}
    assert found["a"] == 3 and found["c"] == 30 and math.isclose(found["b"], 978) and found[None] == 0


def test_license_scan_on_odd_input(spark, documents, odd):
    assert license.scan(odd).count() == odd.count()
    docs = documents([(1, "See the MIT\nLicense. mit license"), (2, "licensed under cc by nc 4 0"), (3, None)])
    found = {r["doc_id"]: r for r in license.scan(docs).collect()}
    assert found[1]["starts"] == [2, 4] and found[1]["base_labels"] == ["mit"]
    assert [m["label"] for m in found[2]["matches"]] == ["cc-by-nc-4.0"] and found[2]["score"] == 1
    assert found[3]["n_words"] == 0 and found[3]["score"] == 0


def test_resampling_on_odd_input(spark, odd):
    labels = spark.createDataFrame([(5, 1, 0), (None, 1, None), (8, 1, 1)], "doc_id long, quality int, toxic int")
    assert importance.resample(odd, labels).count() == odd.count()
    assert importance.resample(odd, labels.where("false")).where("selected").count() >= 5
    assert importance.resample(odd.where("false"), labels).count() == 0


def test_kth_largest(spark):
    values = [1.0, 1.0, 2.5, -3.0, 1e9, 7.25, 7.25]
    table = spark.createDataFrame([(v,) for v in values], "v double")
    for k, want in enumerate(sorted(values, reverse=True), 1):
        assert importance.kth_largest(table, "v", k) == want


def test_top_k_on_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (100, [0.5]), (1, [1.0, None]), (2, None), (3, [nan, 1.0]), (4, [inf, 0.0])]
    rows += [(5, [1.0, 2.0]), (6, [1.0, 2.0]), (7, []), (None, [1.0, 1.0]), (0, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = topk.top_k(table, table.where("vec_id % 100 = 0"), k=3).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in found] == [
        (0, 1, 5, 5 << 20), (0, 2, 6, 5 << 20), (0, 3, 100, 1 << 19),
        (100, 1, 0, 1 << 19), (100, 2, 0, 1 << 19), (100, 3, 5, 1 << 19),
    ]
    assert topk.top_k(table, table.where("false")).count() == 0
    huge = spark.createDataFrame([(0, [1e30]), (1, [1e30]), (2, [-1e30])], "vec_id long, embedding array<double>")
    found = topk.top_k(huge, huge.where("vec_id = 0")).collect()
    assert [(r["vec_id"], r["score"]) for r in found] == [(1, 2**63 - 1), (2, -(2**63))]


def test_top_k_in_blocks_equals_one_block(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    queries = table.where("vec_id % 20 = 0")
    one, many = topk.top_k(table, queries), topk.top_k(table, queries, block=7)
    assert one.exceptAll(many).count() == many.exceptAll(one).count() == 0


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_archives_round_trip(spark, compression):
    big = "é<p>\r\n\r\nWARC/1.1\r\n</p>" * 20
    rows = [(3, "http://a/ b\n", big), (1, None, big), (1, "http://c/?q=%20", big), (None, "u", big), (5, "x", None)]
    rows += [(6, "", "short"), (7, "", "short")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = f"{shared_folder(spark, 'tests')}/warc-{compression}"
    warc.write_warc(warc.page_records(pages), path, compression=compression, rollover="500")
    everything = warc.read_warc(spark, path).collect()
    assert len(everything) == len(rows)
    responses = warc.read_warc(spark, path).where("record_type = 'response'").collect()
    payloads = sorted((r["payload"].decode(), r["payload_length"]) for r in responses)
    assert payloads == sorted([(big, len(big.encode())), ("", 0), ("short", 5), ("short", 5)])
    revisits = warc.read_warc(spark, path, "record_type string, refers_to string, target_uri string")
    revisits = revisits.where("record_type in ('revisit') and target_uri like 'http%'").collect()
    assert all(r["refers_to"].startswith("urn:page:1:") for r in revisits)
    assert {r["target_uri"] for r in everything} >= {"http://a/%20b%0A", None}
    empty = f"{path}-empty"
    warc.write_warc(warc.page_records(pages.where("false")), empty)
    assert warc.read_warc(spark, empty).count() == 0


def test_predicates_reach_the_archive_reader(spark):
    from pyspark.sql.datasource import EqualTo, GreaterThan, StringStartsWith
    from pyspark.sql.types import StructType

    reader = warc.WarcReader("/x", StructType.fromDDL(warc.SCHEMA))
    late = GreaterThan(("payload_length",), 3)
    left = reader.pushFilters([EqualTo(("record_type",), "response"), late, StringStartsWith(("target_uri",), "http")])
    assert list(left) == [late] and len(reader.tests) == 2
