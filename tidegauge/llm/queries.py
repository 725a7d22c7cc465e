"""The operators over the given tables, each as one query, with SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import (
    conversations,
    decontaminate,
    importance,
    language,
    license,
    lines,
    mixing,
    negatives,
    packing,
    simhash,
    substrings,
    topk,
    warc,
)
from tidegauge.llm.common import read_table
from tidegauge.session import shared_folder


def _joined(items: Column) -> Column:
    return F.array_join(items, ",")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    learned = language.profiles(docs.where(~language.held_out(docs["doc_id"])))
    found = language.identify(docs, learned, ["doc_id"])
    doc_id = F.col("row.doc_id")
    held = language.held_out(doc_id).alias("held_out")
    return found.select(doc_id, held, "lang_pred", "score")


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = license.scan(read_table(spark, folder, "documents"))
    base = F.col("base_labels")
    return found.select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        _joined(base).alias("base_labels"),
        _joined(F.array_sort(F.array_union(base, F.col("matches.label")))).alias("labels"),
        "score",
    )


def op3_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op4_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, folder, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op5_quality_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(
        read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    )


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.decontaminate(
        read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(_joined(F.col("item_ids")).cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.mix(read_table(spark, folder, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return found.select("doc_id", "size", "source_size", "target", taken)


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.dedup_substrings(read_table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_folder(spark, 'llm')}/{uuid.uuid4().hex}/archive"
    warc.write_warc(warc.page_records(read_table(spark, folder, "pages")), path)
    # Payloads of responses are read and measured again; of revisits there is only the header.
    full = warc.read_warc(spark, path, "record_type string, record_id string, payload binary")
    responses = full.where("record_type = 'response'").select(
        warc.page_of(F.col("record_id")).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    heads = warc.read_warc(
        spark,
        path,
        "record_type string, record_id string, refers_to string, payload_digest string, "
        "payload_length long",
    )
    revisits = heads.where("record_type = 'revisit'").select(
        warc.page_of(F.col("record_id")).alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"),
        "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"),
    )
    return responses.unionByName(revisits)


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.repeated_lines(read_table(spark, folder, "documents"))
    removed = F.col("removed")
    return found.select(
        "doc_id",
        "n_lines",
        F.size(removed).cast("long").alias("n_removed"),
        _joined(removed.cast("array<string>")).alias("removed"),
    )


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    given = read_table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = given.withColumn("label", moved)
    return negatives.hard_negatives(vectors, vectors.where("vec_id % 100 = 0"))


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read_table(spark, folder, "documents"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = read_table(spark, folder, "conversations")
    rows = conversations.damaged(given)
    found = conversations.summary(conversations.repair(rows))
    missing = conversations.gaps(rows)
    every = given.select("conv_id").distinct()
    # Conversations that lost all rows, and null as an id, need a row too: added up, not joined.
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    all_rows = found.unionByName(missing, True).unionByName(every, True)
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return all_rows.groupBy("conv_id").agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts),
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), nothing).alias("repaired_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_license_scan,
        op3_top_k,
        op4_simhash_near_dedup,
        op5_quality_resampling,
        op6_decontamination,
        op7_mixing,
        op8_substring_dedup,
        op9_warc,
        op10_line_dedup,
        op11_hard_negatives,
        op12_packing,
        op13_conversation_repair,
    )
}
