"""From raw documents to packed training sequences: five stages, each one operator of the library.

Every stage gets what the one before it kept, as a table that was written and read again, and returns
the columns of `documents`; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import mixing, repeats, rules, simhash, tiers, tokens
from staylens.llm.store import stored

REST = "_rest"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _set_apart(docs: DataFrame, *used: str) -> DataFrame:
    """`docs` with the columns in `used`, and the others as one: names that a stage makes never replace the input's."""
    return docs.select(*[docs[c] for c in used], F.struct(*[docs[c] for c in docs.columns if c not in used]).alias(REST))


def _whole(parts: DataFrame, docs: DataFrame, *used: str, **new: Column) -> DataFrame:
    """The columns of `docs` again, those in `new` replaced."""
    return parts.select(*[(new[c] if c in new else F.col(c) if c in used else F.col(REST)[c]).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go. Null and empty texts are rejected."""
    return rules.passing(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest id stays."""
    return simhash.one_of_each(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes that a repeated 200-byte string covers go; a text that is all repeats stays as an empty one."""
    cut = repeats.without_repeats(_set_apart(docs, "doc_id", "text"))
    shorter = cut.withColumn("text", repeats.kept_text(cut["text"], cut["repeat_spans"]))
    new = {"n_chars": F.char_length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return _whole(shorter, docs, "doc_id", "text", **new)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or dropped by chance until sources have shares by the root of their size."""
    used = ("doc_id", "text", "source")
    return _whole(mixing.mixed(_set_apart(docs, *used)), docs, *used)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows of full length, one row per piece of a document."""
    return tiers.packed(docs, tokens.word_vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("suffix_dedup", suffix_dedup),
    ("mixing_sources", mixing_sources),
    ("packing", packing),
]

# Fingerprints, repeated strings and token ids are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
