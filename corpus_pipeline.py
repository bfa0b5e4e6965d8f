"""Five stages from raw documents to packed training sequences.

Each stage takes what its predecessor kept, in the columns of `documents`, and its decisions
take effect: rejected documents and copies go, repeated passages are cut out of the texts,
documents with benchmark passages go, and the rest is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyroll.llm.decontamination import without_leaks
from tallyroll.llm.jaccard import first_of_group
from tallyroll.llm.packing import packed
from tallyroll.llm.quality_rules import passing
from tallyroll.llm.repeats import cut_repeats
from tallyroll.llm.shared import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules; trusted text is what the labels call good."""
    return passing(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard 0.8): the first."""
    return first_of_group(docs, k=5, num=80, den=100)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that also start in a document with a smaller id."""
    return cut_repeats(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    from public_tokenizers import path

    return packed(docs, path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_passages),
    ("packing", packing),
]

#: Tokenizing and edit distance are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
