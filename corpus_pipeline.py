"""Corpus pipeline: language ID, line dedup, near dedup, source mix, packing.

Each stage works on all that its predecessor kept and its decisions take effect: rejected
documents and copies go, deleted lines leave the text, the mix repeats or drops rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import lang_id, line_dedup, mixing, packing, simhash
from tidewright.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; ``lang`` becomes the language found."""
    return lang_id.known_language(docs, lang_id.train(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later repeated runs of lines; documents that lose all their lines go."""
    clean = line_dedup.dedup_lines(docs, min_words=50)
    left = clean.where((F.col("lines_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return simhash.keep_first(docs, shingle=3, max_bits=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs, weights=(1.0, 2.0, 3.0), cap=3.0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences of 2048 tokens."""
    return packing.pack_documents(docs, capacity=2048)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_dedup),
    ("source_mix", mix),
    ("best_fit_packing", pack),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
