"""The corpus pipeline: documents in, packed pieces out, five stages written one after another."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm import decontamination, packing, quality_rules, repeats, simhash
from tamiz.llm.common import frozen, load


def with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text where the table has it."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null and empty texts fail them."""
    return quality_rules.keep_good(docs, load(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the smallest doc_id, one of repeated rows."""
    return simhash.keep_one(docs, written=True)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without passages of 100 bytes or more that occur earlier; null texts become empty."""
    return with_length(repeats.without_repeats(docs))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of powers of two with their token ids; a document without text has its end id alone."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", rules),
    ("simhash", near_duplicates),
    ("suffix_array", repeated_passages),
    ("decontamination", benchmark),
    ("packing", pack),
]

#: Token ids and suffix arrays are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each is written and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = frozen(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
