"""Token counts by a two-tier lookup on the map side.

First tier: a table of frequent pre-tokens and their token counts. Each task keeps a Misra-Gries summary of
the pre-tokens it reads (``SUMMARY`` entries at most); the summaries, not the pre-tokens, are added up,
and the ``FREQUENT`` largest are encoded once and broadcast. Second tier: what is not in the table is
encoded by the worker that meets it, and kept in a cache of ``CACHED`` entries. No pre-token is
shuffled. The tables only save work; counts are exact without them.

Defined results: a null text is empty and has 0 bytes and 0 tokens. Special strings inside a text count as
the library counts them by default (one special token). Texts outside the fast range of the encoder,
or with special strings, are counted by encoding them whole. Other columns are not read; repeated
rows are counted each; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.base import pieces, text_of, texts_of
from claimlens.llm.tokenizer import PRETOKEN, Encoder, encoder

SUMMARY = 1 << 14
FREQUENT = 1 << 16
CACHED = 400_000


def splittable(e: Encoder, text: str) -> bool:
    return e.settled(text) and not any(s in text for s in e.special)


def frequent_pretokens(df: DataFrame, path: str, text: str = "text", most: int = FREQUENT) -> dict[str, int]:
    """Pre-token to token count of the most frequent pre-tokens: ``most`` at most, so it may be broadcast."""

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, e, counts = regex.compile(PRETOKEN).findall, encoder(path), Counter()
        for batch in pieces(batches):
            for value in texts_of(batch.column(0)):
                if splittable(e, value):
                    counts.update(split(value))
            if len(counts) > 8 * SUMMARY:
                counts = shrink(counts)
        counts = shrink(counts)
        # A pre-token longer than this is no help in a table.
        kept = [(k, n) for k, n in counts.items() if len(k) <= 64]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["pretoken", "n"]
        )

    found = (
        df.select(text_of(text).alias("text"))
        .mapInArrow(summaries, "pretoken string, n long")
        .groupBy("pretoken")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "pretoken")
        .limit(most)
        .collect()
    )
    e = encoder(path)
    return {r.pretoken: len(e.encode(r.pretoken)) for r in found}


def shrink(counts: Counter) -> Counter:
    """Misra-Gries: take the count of the first entry that has no room off all others."""
    if len(counts) <= SUMMARY:
        return counts
    over = sorted(counts.values(), reverse=True)[SUMMARY]
    return Counter({k: n - over for k, n in counts.items() if n > over})


class Rare(dict):
    """Token counts of pre-tokens met by this worker."""

    def __init__(self, e: Encoder):
        self.e = e

    def __missing__(self, pretoken: str) -> int:
        if len(self) >= CACHED:
            self.clear()
        n = self[pretoken] = len(self.e.fast.encode_ordinary(pretoken))
        return n


class Tiers(dict):
    """The broadcast table; what it lacks is looked up in the worker's own cache."""

    rare: Rare

    def __missing__(self, pretoken: str) -> int:
        return self.rare[pretoken]


def count_tokens(df: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, n_bytes, n_tokens of each row."""
    table = df.sparkSession.sparkContext.broadcast(frequent_pretokens(df, path, text))
    id_type = df.schema[id].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, e = regex.compile(PRETOKEN).findall, encoder(path)
        tiers = Tiers(table.value)
        tiers.rare = Rare(e)
        look_up = tiers.__getitem__  # dict.__getitem__ calls __missing__
        for batch in pieces(batches):
            numbers = [
                sum(map(look_up, split(value))) if splittable(e, value) else len(e.encode(value))
                for value in texts_of(batch.column(2))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(numbers, pa.int64())], [id, "n_bytes", "n_tokens"]
            )

    content = text_of(text)
    given = df.select(F.col(id), F.octet_length(content).cast("long").alias("n_bytes"), content.alias("__text"))
    return given.mapInArrow(counted, f"`{id}` {id_type}, n_bytes long, n_tokens long")
