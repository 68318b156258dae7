"""The registered queries of the operators and their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larder.llm import clusters, mixture, vector_codes
from larder.llm.bpe import bpe_round_trip
from larder.llm.decontaminate import contaminations
from larder.llm.exact_dedup import exact_dedup
from larder.llm.fm_dedup import remove_earlier
from larder.llm.fuzzy_lines import line_digests
from larder.llm.ngram_join import similar_documents
from larder.llm.pii import span_digests
from larder.llm.quality import quality_scores
from larder.llm.suffix_dedup import remove_repeats
from larder.llm.tables import documents
from larder.llm.token_files import token_file_digests
from larder.llm.vector_sql import clusters_sql, codes_sql

TOKENIZERS = os.environ.get("LARDER_TOKENIZERS", "/opt/tokenizers")
END_ID = 2

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql:
            ORACLE_SQL[name] = sql
        return build

    return register


@query(
    "op1_exact_dedup",
    r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), r AS (
  SELECT doc_id, sha256(norm) AS text_sha256, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id) AS keep_id
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


@query("op4_token_files")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digests(documents(spark, sf_dir), f"{TOKENIZERS}/word_bpe_49k.json", END_ID)


@query("op8_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(documents(spark, sf_dir), f"{TOKENIZERS}/word_bpe_49k.json")


@query("op9_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op2_suffix_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


@query("op3_substring_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_earlier(documents(spark, sf_dir))


@query("op5_ngram_join")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(documents(spark, sf_dir))


@query("op6_pii")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(documents(spark, sf_dir))


@query("op10_fuzzy_lines")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digests(documents(spark, sf_dir))


@query("op7_decontaminate")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


# The SQL cuts vectors of the tables' own 64 components.
@query("op11_vector_codes", codes_sql(vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS, vector_codes.SCALE, 64))
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_digests(embeddings(spark, sf_dir))


@query("op12_clusters", clusters_sql(clusters.CLUSTERS, clusters.ROUNDS, clusters.SCALE, clusters.DIMENSIONS, clusters.SEED))
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster_digests(embeddings(spark, sf_dir))


@query("op13_mixture", mixture.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mixture(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")
