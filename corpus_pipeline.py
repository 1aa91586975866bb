"""A training corpus from raw documents, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; each is written as Parquet and read again
for the next one. All but the last return the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm import bpe, exact_dedup, mixing, near_dedup, quality
from claimlens.llm.base import ready, stored, table

# Near copies: texts that share this much of their distinct shingles of five words.
SHINGLE, SHARE = 5, 0.8


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host isn't rejected."""
    ready(spark)
    return quality.apply(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text: the largest doc_id."""
    ready(spark)
    return exact_dedup.dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest doc_id."""
    ready(spark)
    return near_dedup.dedup(docs, width=SHINGLE, share=SHARE)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in shuffled shards."""
    ready(spark)
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's ids (little-endian unsigned 32-bit integers), their number, and whether they decode to the text."""
    ready(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    narrow = docs.select("doc_id", "source", "text")  # other columns may have any name
    return bpe.encode(narrow, path, ids="token_ids", decoded="decoded").select(
        "doc_id",
        "source",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        "token_ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("decodes"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("source mix", source_mix),
    ("bpe", token_ids),
]

# Neither SimHash's XXH64 nor the tokenizer can be had in SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
