"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import bestfit, lexical, lines, mixing, repeats, rules, shards, simhash, tiers, tokens, toxicity, turns, vafile, warc
from staylens.llm.oracle import ORACLE_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_vector_approximation(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return vafile.top_k(vectors, vectors.filter("vec_id % 100 = 0"))


def op2_tier_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = tiers.packed(_table(spark, sf_dir, "documents"), tokens.word_vocabulary())
    crc = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset", "tier", "step_group")


def op3_bestfit_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.matrices(_table(spark, sf_dir, "documents"), tokens.word_vocabulary())


def op4_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.shuffled(_table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return placed.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.without_repeats(_table(spark, sf_dir, "documents"))
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint")
    return cut.select(
        "doc_id",
        size.alias("n_bytes"),
        (size - F.octet_length("kept")).alias("n_removed"),
        F.size("repeat_spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archived(_table(spark, sf_dir, "pages"))
    read = spark.read.format("warc").option("payload", "verify").load(folder)
    return read.select(
        warc.page_number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc.page_number("refers_to").alias("refers_to")
    )


def op8_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    field = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, field)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judged(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_classes(_table(spark, sf_dir, "documents"))
    return classes.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = lines.keep_bitmaps(_table(spark, sf_dir, "documents"))
    kept = lines.kept_lines(F.col("text"), F.col("n_lines"), F.col("keep"))
    return judged.select("doc_id", "n_lines", "n_dropped", F.sha2(kept, 256).alias("kept_sha256"))


def op12_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    rows = turns.damaged(conversations)
    edits = turns.edited(rows)
    return turns.reports(conversations, edits, turns.repaired(rows, edits))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_vector_approximation": op1_vector_approximation,
    "op2_tier_packing": op2_tier_packing,
    "op3_bestfit_matrices": op3_bestfit_matrices,
    "op4_hypergeometric_shards": op4_hypergeometric_shards,
    "op5_poisson_mix": op5_poisson_mix,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_warc": op7_warc,
    "op8_toxic_spans": op8_toxic_spans,
    "op9_quality_rules": op9_quality_rules,
    "op10_simhash": op10_simhash,
    "op11_line_dedup": op11_line_dedup,
    "op12_bag_search": op12_bag_search,
    "op13_turn_repair": op13_turn_repair,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
