"""The corpus pipeline: documents through five stages, each calling one operator of ``larder.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.llm.bpe import bpe_round_trip
from larder.llm.decontaminate import without_contaminated
from larder.llm.exact_dedup import drop_copies
from larder.llm.ngram_join import keep_one_of_similar
from larder.llm.quality import keep_good
from larder.llm.queries import TOKENIZERS
from larder.llm.tables import documents, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    return drop_copies(docs)


def similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents one stays; near duplicates have four of five five-word shingles in common."""
    return keep_one_of_similar(docs, shingle=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item go."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left, encoded and decoded."""
    return bpe_round_trip(docs, f"{TOKENIZERS}/word_bpe_49k.json")


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact),
    ("ngram_join", similar),
    ("decontamination", decontaminated),
    ("bpe", encoded),
]

# SQL can express neither the classifier nor the encoding; tests compare the other stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
