"""Quality rules of documents and of their hosts.

Base counts come from the text alone. A document fails when its text is bad (``base_failed``), or when one
of the softer rules is broken: too many symbols, or too many repeated lines. Failures are added up by
host (here: the source). A host's failure rate is shrunk towards those of all hosts: the rates are taken
for draws of a beta distribution whose two parameters are estimated by moments, weighted by documents, and the
posterior mean counts. A host above ``HOST_LIMIT`` is rejected with all its documents; all other documents
stay unless they have ``base_failed``.

Defined results: a null text has no words and has ``base_failed``. Null hosts are one host. Repeated rows count
each. With one host, or with hosts all alike, the prior is a single pseudo-document at the overall
rate. An empty table gives no rows. ``apply`` carries all columns along; helper columns have names of
their own (``__q_*``).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from claimlens.llm.base import WORD, pieces, stored, texts_of

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# A document is bad below so many words, or above this share of words in repeated windows.
MIN_WORDS, MAX_REPEATED = 10, 0.2
# Softer rules, which only count for the host: symbols per word, repeated lines per word.
MAX_SYMBOLS, MAX_LINES = 1.0, 0.2
# A host is rejected above this shrunk rate of failing documents.
HOST_LIMIT = 0.8

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

find_words = re.compile(WORD).findall


def repeated_words(words: list[str]) -> int:
    """Words that lie in a window found twice or more."""
    windows = list(zip(*[words[k:] for k in range(WINDOW)]))
    counts = Counter(windows)
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered += i + WINDOW - max(i, end)
            end = i + WINDOW
    return covered


def may_repeat(texts: list[list[str]]) -> np.ndarray:
    """Whether a text may hold a window twice: equal hashes of windows within a text. No wrong misses."""
    lengths = np.array([len(t) for t in texts], np.int64)
    n = int(lengths.sum())
    if n < WINDOW:
        return np.zeros(len(texts), bool)
    hashed = np.fromiter((hash(w) for t in texts for w in t), np.int64, n).view(np.uint64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    rolled = np.zeros(n - WINDOW + 1, np.uint64)
    for k in range(WINDOW):
        rolled = (rolled ^ hashed[k : n - WINDOW + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        rolled ^= rolled >> np.uint64(29)
    inside = owner[: n - WINDOW + 1] == owner[WINDOW - 1 :]
    rolled, owner = rolled[inside], owner[: n - WINDOW + 1][inside]
    rolled += owner.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    order = np.argsort(rolled)
    twice = rolled[order][1:] == rolled[order][:-1]
    found = np.zeros(len(texts), bool)
    found[owner[order[1:][twice]]] = True
    return found


def count_all(texts: list[str]) -> list[list[int]]:
    """The base counts of each text, by column."""
    words = [find_words(t) for t in texts]
    again = may_repeat(words)
    out: list[list[int]] = [[] for _ in COUNTS]
    for text, ws, repeats in zip(texts, words, again.tolist()):
        lines = [x for x in text.split("\n") if x.strip(SPACE)]
        values = (
            len(ws),
            sum(map(len, ws)),
            sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)),
            repeated_words(ws) if repeats else 0,
        )
        for column, value in zip(out, values):
            column.append(value)
    return out


def with_counts(df: DataFrame, text: str, prefix: str = "") -> DataFrame:
    """All columns and the base counts, as ``prefix`` + name."""
    at = df.columns.index(text)
    names = [prefix + c for c in COUNTS]
    schema = StructType([*df.schema.fields, *[StructType().add(n, LongType())[0] for n in names]])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            made = [pa.array(c, pa.int64()) for c in count_all([str(t) for t in texts_of(batch.column(at))])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *names])

    return df.mapInArrow(counted, schema)


def base_failed(prefix: str = "") -> Column:
    words, repeated = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (words < MIN_WORDS) | (repeated * 100 > words * int(MAX_REPEATED * 100))


def fails(prefix: str = "") -> Column:
    words = F.col(prefix + "n_words")
    return (
        base_failed(prefix)
        | (F.col(prefix + "n_symbols") > words * MAX_SYMBOLS)
        | (F.col(prefix + "n_dup_lines") > words * MAX_LINES)
    )


def host_verdicts(counted: DataFrame, host: Column, prefix: str = "", limit: float = HOST_LIMIT) -> DataFrame:
    """One row per host: host, n_docs, n_failed, rate, host_kept."""
    hosts = counted.groupBy(host.alias("host")).agg(
        F.count("*").alias("n_docs"), F.sum(fails(prefix).cast("long")).alias("n_failed")
    )
    # One summary row: the overall rate m, and the variance between hosts less what chance alone would
    # give. alpha + beta = m (1 - m) / variance - 1.
    own = F.col("n_failed") / F.col("n_docs")
    total = hosts.agg(
        F.sum("n_docs").alias("n"),
        F.count("*").alias("k"),
        F.sum("n_failed").alias("failed"),
        F.sum(F.col("n_docs") * own * own).alias("squares"),
    ).first()
    n = total["n"] or 1
    m = (total["failed"] or 0) / n
    between = (total["squares"] or 0.0) / n - m * m - m * (1 - m) * total["k"] / n
    strength = max(m * (1 - m) / between - 1, 1.0) if between > 0 else 1.0
    rate = (F.col("n_failed") + m * strength) / (F.col("n_docs") + strength)
    return hosts.withColumn("rate", rate).withColumn("host_kept", F.col("rate") <= limit)


def host_key(host: str) -> Column:
    name = F.col(host).cast("string")
    return F.when(name.isNull(), F.lit("n")).otherwise(F.concat(F.lit("b"), name))


def decide(
    df: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source", limit: float = HOST_LIMIT
) -> DataFrame:
    """One row per row: id, the base counts, base_failed, kept."""
    given = df.select(F.col(id), host_key(host).alias("host"), F.col(text).cast("string").alias("__q_text"))
    counted = stored(with_counts(given, "__q_text").drop("__q_text"), "quality-counts")
    verdicts = host_verdicts(counted, F.col("host"), limit=limit).select("host", "host_kept")
    return counted.join(verdicts, "host").select(
        F.col(id),
        *COUNTS,
        base_failed().alias("base_failed"),
        (~base_failed() & F.col("host_kept")).alias("kept"),
    )


def apply(df: DataFrame, text: str = "text", host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """The rows that stay, with the columns of ``df``."""
    given = df.withColumns({"__q_host": host_key(host), "__q_text": F.col(text).cast("string")})
    # The counts of all rows decide about the hosts; the texts are read again for the rows that stay.
    counted = stored(
        with_counts(given.select("__q_host", "__q_text"), "__q_text", "__q_").drop("__q_text"), "quality-counts"
    )
    verdicts = stored(host_verdicts(counted, F.col("__q_host"), "__q_", limit), "host-verdicts")
    bad = verdicts.where(~F.col("host_kept")).select(F.col("host").alias("__q_host"))
    passed = with_counts(given, "__q_text", "__q_").where(~base_failed("__q_"))
    return passed.join(bad, "__q_host", "left_anti").select(*df.columns)
