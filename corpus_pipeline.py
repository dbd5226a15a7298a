"""From documents to training sequences: quality, repeated passages, near duplicates, benchmark leaks, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.common import read
from ebbtide.llm.group_join import representatives
from ebbtide.llm.line_dedup import without_repeats
from ebbtide.llm.packing import packed, vocabulary
from ebbtide.llm.quality import kept_documents
from ebbtide.llm.winnowing import clean_documents
from ebbtide.session import work_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier rejects go."""
    return kept_documents(docs, read(spark, sf_dir, "labels"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of passages of eight words or more go; a document of which nothing else is left goes too."""
    kept = without_repeats(docs, least_words=8).where("n_removed = 0 OR n_removed < n_lines")
    return kept.select(*[F.char_length("text").cast("bigint").alias(c) if c == "n_chars" else c for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group linked by a Jaccard similarity of 0.8 on five-word shingles."""
    return representatives(docs, width=5, percent=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or a whole shorter one, go."""
    return clean_documents(docs, read(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' pieces in sequences of 2048 tokens."""
    return packed(docs, *vocabulary())


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", repeated_lines),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_leaks),
    ("best_fit_packing", sequences),
]

# Hashing of words, tokenizing and packing have no SQL form; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    folder, docs = f"{work_folder(spark)}/pipeline-{uuid.uuid4().hex}", read(spark, sf_dir, "documents")
    for name, step in STAGES:
        step(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
