"""From documents to token ids: five stages over the whole corpus, each written and read again.

1. ``quality``: the byte-level network drops documents that it rejects.
2. ``near_duplicates``: of each group of documents linked by sharing 0.8 of their five-word shingles one
   stays, that of the smallest id; SimHash proposes the groups.
3. ``personal_data``: spans of personal data are replaced by their kind.
4. ``mix``: documents are replicated or left out so that sources meet their target weights, and
   shuffled.
5. ``encode``: token ids of every text, checked by decoding.

All but the last return the columns of ``documents``. A document here is a row: where an id occurs
in several rows of a group of near-duplicates, the row of the smallest text stays.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.llm import bpe, mixing, pii, quality, simhash
from vitals.llm.tables import ship, stored, table

COLUMNS = "doc_id text lang source n_chars".split()
# Candidates are fingerprints of two-word shingles within seven bits in one of three families, which find nearly
# all pairs that share 0.8 or more of their five-word shingles (README); the exact check is in ``one_of_each``.
NEAR = {"width": 2, "threshold": 7, "parts": 4, "families": 3}
# A trained classifier and 64-bit fingerprints have no SQL form; tests hold the result against a
# brute-force version.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labels of the raw corpus, then keeps what scores at least the threshold."""
    ship(spark)
    network = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.scored(docs, network, "_score").filter(F.col("_score") >= quality.THRESHOLD).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash.one_of_each(docs, **NEAR).select(*COLUMNS)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs).withColumn("n_chars", F.char_length("text").cast("bigint")).select(*COLUMNS)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.replicate(docs).select(*COLUMNS)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per copy of a document: its source, ids, their number, and whether they decode to its text."""
    ship(spark)
    coded = bpe.round_trip(docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("_text"), "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id",
        "source",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.col("_text")).alias("decodes"),
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("personal_data", personal_data_stage),
    ("mix", mix_stage),
    ("encode", encode_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents of ``sf_dir``; each but the last is stored in between."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
