"""The registered queries of the operators, and their SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm import (
    alignment,
    bpe,
    chat,
    exact_dedup,
    html_text,
    mixing,
    packing,
    quality,
    repair,
    repair_sql,
    sharding,
    simhash,
    token_counts,
    token_files,
)
from claimlens.llm.base import table
from claimlens.session import run_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


CHAT_PROBE = "</s>[INST] ok [/INST]"


@register
def op2_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one whose texts look like a template, formatted and read back."""
    given = table(spark, folder, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    probe = spark.createDataFrame(
        [(-7, 0, "user", CHAT_PROBE), (-7, 1, "assistant", CHAT_PROBE)], "conv_id long, turn long, role string, text string"
    )
    back = chat.read_back(chat.windows(given.unionByName(probe)))
    learnt = F.array_join("losses", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(
            F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256
        ).alias("turns_sha256"),
        F.char_length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        "formatted_chars",
    )


@register
def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.decide(table(spark, folder, "documents"))


ORACLES["op3_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@register
def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.decide(table(spark, folder, "documents"))


@register
def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, folder, "documents"), shards=24)


def tokenizer() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@register
def op1_bpe_chunk_reuse(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode(docs, tokenizer(), keep_text=False, decoded="decoded").select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register
def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = run_folder(table(spark, folder, "documents").sparkSession, "tokens")
    token_files.write_tokens(table(spark, folder, "documents"), path, tokenizer(), end_id=2)
    return token_files.read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


TOKEN_LIMIT = 512


@register
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, folder, "documents"), tokenizer())
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@register
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.decide(table(spark, folder, "documents"))


@register
def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.decide(table(spark, folder, "documents"))


@register
def op10_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages").select("page_id", "url", "html")).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )


ORACLES["op7_quality_rules"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, source,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), windows AS (
  SELECT r, unnest(range(1, len(words) - 3)) AS i, words FROM docs
), named AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2], words[i + 3], words[i + 4]) AS n
  FROM windows
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words
  FROM named, (SELECT unnest(range(5)) AS k) WHERE n > 1 GROUP BY r
), lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs
), repeated AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), base AS (
  SELECT docs.r, doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM docs LEFT JOIN covered ON docs.r = covered.r LEFT JOIN repeated ON docs.r = repeated.r
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base
), hosts AS (
  SELECT source, count(*) AS n,
         count(*) FILTER (base_failed OR n_symbols > n_words OR n_dup_lines > 0.2 * n_words) AS failed
  FROM judged GROUP BY source
), totals AS (
  SELECT CAST(sum(failed) AS DOUBLE) / sum(n) AS m, CAST(sum(n) AS DOUBLE) AS n, count(*) AS k,
         sum(n * (failed / n) * (failed / n)) AS squares FROM hosts
), spread AS (
  SELECT m, squares / n - m * m - m * (1 - m) * k / n AS between_hosts FROM totals
), prior AS (
  SELECT m, CASE WHEN between_hosts > 0 THEN greatest(m * (1 - m) / between_hosts - 1, 1) ELSE 1 END AS strength
  FROM spread
), verdicts AS (
  SELECT source, (failed + m * strength) / (n + strength) <= 0.8 AS host_kept FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND host_kept AS kept
FROM judged JOIN verdicts ON judged.source IS NOT DISTINCT FROM verdicts.source
"""


@register
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Byte-level BPE tokens against sentencepiece tokens of every whole text."""
    return alignment.decide(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def damaged(df: DataFrame) -> DataFrame:
    """Conversations as a faulty export might leave them: rows lost, emptied, without stops, doubled, or all of users."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    way = F.crc32(name) % 20
    times = F.explode(F.when(way == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return df.where(way != 0).select(
        "conv_id",
        "turn",
        F.when(way == 4, "user").otherwise(role).alias("role"),
        F.when(way == 1, "").when(way == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        times,
    )


@register
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, damaged and repaired; conversations that lost all rows too."""
    given = table(spark, folder, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    found = repair.report(damaged(given)).withColumnRenamed("conv_id", "found_id")
    all_ids = given.groupBy("conv_id").agg(F.lit(1).alias("one"))
    joined = all_ids.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    nothing = hashlib.sha256().hexdigest()
    return joined.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in repair.FACTS),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )


@register
def op11_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every whole document in sequences of 4,096 tokens."""
    path = public_tokenizers.path("word_bpe_49k.json")
    _, placed = packing.pack(table(spark, folder, "documents"), path, end_id=1, capacity=4096)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


ORACLES["op12_conversation_repair"] = repair_sql.SQL
