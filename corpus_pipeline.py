"""Corpus pipeline over ``documents``: each stage applies one operator of ``quoteline.llm`` to all rows that its
predecessor kept, and returns the columns of its input (the last stage returns digests of the token ids).

A stage that filters drops whole documents; line dedup also changes texts (``n_chars`` follows the text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteline.llm import decontamination, language_id, line_dedup, near_dedup, sentencepiece_codec
from quoteline.llm.common import importable, stored, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID (5): documents without a letter, or in no learned language, go."""
    importable(spark)
    model = language_id.train(docs.where(~language_id.is_held_out()))
    return language_id.keep_identified(docs, model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup (1): repeated lines go; so does a document all of whose lines are repeats."""
    importable(spark)
    found = line_dedup.remove_repeated_lines(docs)
    lines, removed = found.columns[-2:]
    kept = found.where((F.col(removed) < F.col(lines)) | (F.col(lines) == 0))
    columns = {c: F.col(c) for c in docs.columns}
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(F.col(removed) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")).alias("n_chars")
    return kept.select(*columns.values())


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup (9): one document of each group stays, the one of the smallest id."""
    importable(spark)
    return near_dedup.one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (4): documents that hold a window of a test item go."""
    importable(spark)
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"), null_items=True)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece encoding and decoding (10)."""
    importable(spark)
    return sentencepiece_codec.round_trip_digests(docs)


STAGES = [
    ("language", language_stage),
    ("lines", line_stage),
    ("near_duplicates", near_stage),
    ("benchmark", benchmark_stage),
    ("sentencepiece", encode_stage),
]

#: The stages are not expressible in SQL; each is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
