"""One query per operator over its whole table; ``ORACLE_SQL`` holds the same result as DuckDB SQL.

Operators without SQL there are tested against brute force in ``tests/llm``: byte-pair ids, grammar
files, vector search, fingerprints and trained classifiers have no sensible SQL form.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vitals.llm import bpe, chat, mixing, pii, postings, quality, repair, repetition, simhash, spelling, toxicity, viterbi, vptree
from vitals.llm.tables import ship, table

Query = Callable[[SparkSession, str], DataFrame]

BPE_VOCABULARY = "byte_bpe_50k.json"
REPETITION_COLUMNS = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = repair.write_shards(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_VOCABULARY))
    return repair.read_documents(blocks)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


def op3_vantage_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vptree.nearest(vectors, vectors.filter("vec_id % 50 = 0"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_VOCABULARY))


def op5_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicate(table(spark, sf_dir, "documents"))


def op6_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetition.repetition(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = f"n_repeat_words_{repetition.BASE_LENGTH}"
    return found.withColumnRenamed(base, "n_repeat_words").select("doc_id", *REPETITION_COLUMNS)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(spark, table(spark, sf_dir, "conversations"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.digests(table(spark, sf_dir, "conversations"))


def op13_benchmark_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: list[Query] = [
    op1_token_shards,
    op2_pii,
    op3_vantage_points,
    op4_bpe_round_trip,
    op5_poisson_mix,
    op6_repetition,
    op7_simhash,
    op8_toxicity,
    op9_quality,
    op10_chat,
    op11_spelling_variants,
    op12_conversation_repair,
    op13_benchmark_index,
]


def queries() -> dict[str, Query]:
    def ready(query: Query) -> Query:
        @wraps(query)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return query(spark, sf_dir)

        return run

    return {q.__name__: ready(q) for q in QUERIES}
