"""A training corpus from documents: five stages, each written as Parquet and read again by the next one.

1. quality rules: documents that the fixed rules or the learned trees reject go;
2. line dedup: lines that repeat an earlier line, or are one word away from it, go, and documents that lose all words with them;
3. SimHash near-dedup: of each group of near duplicates the document with the least identifier stays;
4. benchmark decontamination: documents that hold a passage of the benchmark go;
5. BPE encoding and decoding: the tokens of each document that is left, and checksums of them and of their text.

All stages but the last return the columns of documents; ``n_chars`` follows the text.

Cases: a NULL or empty text, or one of fewer than 50 words, fails the fixed rules and goes in the first stage; NULL in any other
column stays as it is, and a NULL identifier is one like others; texts of any length are taken whole; of repeated rows, and of rows of one
identifier whose texts are near duplicates, one stays; ties go to the least identifier; an empty table of documents gives an empty
result, without labels the fixed rules alone decide, and without a benchmark nothing is contaminated; more columns of documents,
whatever their names, are kept by all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keysweep.llm.bpe import bpe, bpe_digest
from keysweep.llm.decontaminate import decontaminate
from keysweep.llm.line_dedup import line_dedup
from keysweep.llm.quality import quality_filter
from keysweep.llm.queries import vocabulary_path
from keysweep.llm.simhash import simhash_dedup
from keysweep.llm.staging import Stage, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup(docs, emptied=False)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_digest(bpe(docs, vocabulary_path()), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("bpe encoding and decoding", token_stage),
]

# The trees of the first stage and the merges of the last cannot be put in SQL; tests compare run() with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of the corpus that the stages make of the table documents."""
    stage = Stage(spark, "corpus-pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
