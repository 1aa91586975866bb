"""Which tokens of two tokenizers cover the same bytes of a text, and which pairs of ids go together in a corpus.

Both sides are offsets into the bytes of a space and the text. Per Arrow batch, one ``merge_asof`` keyed by document finds for each
token's start the other side's token that covers it, in both directions; the union of the two is all overlaps. Offsets at which tokens of
both sides end cut them into groups.

What a document needs later (its distinct linked pairs of ids and how often each occurs) is written once, packed. A pair's
count is the number of documents that hold it. Counts come back in two ways: the most frequent pairs, ``FREQUENT`` at most, in a
broadcast table; the others by a join, in which no key can be hot, since every frequent one is in the table.

Defined results: a text that is null or empty, or that one side does not give back byte by byte, has no tokens: zeros and an empty
digest. Repeated rows are documents of their own, each counted. Rows without id stay. An empty table gives an empty result. Of the given
columns only the id and the text are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlens.llm.base import pieces, stored
from claimlens.llm.pretokens import piece_encoder
from claimlens.llm.tokenizer import encoder

# Pairs in the broadcast table at most; some 10 MB.
FREQUENT = 1 << 18

# Counts are sorted into this many levels to a doubling, to find the least count of the broadcast table.
LEVELS = 8

# Bytes of text that a worker aligns at a time.
BATCH_CHARS = 1_000_000

ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


class Sides:
    """Both tokenizers, the length of each id's bytes, and the texts from which group strings are joined."""

    def __init__(self, first: str, second: str):
        self.a, self.b = encoder(first), piece_encoder(second)
        if self.a.bytes_of is None:
            raise ValueError(f"{first} is no byte-level BPE")
        a_bytes = [self.a.bytes_of.get(i, b"") for i in range(max(self.a.bytes_of) + 1)]
        self.bytes = a_bytes, self.b.bytes_of
        self.lengths = [np.array([len(x) for x in side], np.int64) for side in self.bytes]
        # "id," and what follows the last id of a side in a group: "id|" and "id;".
        names = [f"{i}{c}" for side, last in zip(self.bytes, "|;") for i in range(len(side)) for c in ("," + last)]
        self.names = np.array(names, object)

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, or None if one of them does not give the text back."""
        spaced = " " + text
        ids = self.a.encode_plain(spaced), self.b.encode(text)
        data = spaced.encode()
        for side, bytes_of in zip(ids, self.bytes):
            if b"".join(map(bytes_of.__getitem__, side.tolist())) != data:
                return None
        return ids


@lru_cache(maxsize=1)
def sides(first: str, second: str) -> Sides:
    return Sides(first, second)


def align(texts: list[str | None], s: Sides) -> tuple[list, list, list, list, list, np.ndarray, np.ndarray, np.ndarray]:
    """n_a, n_b, n_groups, n_links and digest of each text; then the offsets of each text's pairs, the pairs, their times."""
    found = [s.tokens(t) if t else None for t in texts]
    empty = np.empty(0, np.uint32)
    runs = [[f[k] if f else empty for f in found] for k in (0, 1)]
    sizes = [np.array([len(r) for r in side], np.int64) for side in runs]
    ids = [np.concatenate(side).astype(np.int64) if side else empty.astype(np.int64) for side in runs]
    docs = [np.repeat(np.arange(len(texts)), n) for n in sizes]
    # Offsets run on over the texts of a batch, so that starts ascend over all of it.
    ends = [np.cumsum(lengths[i]) for lengths, i in zip(s.lengths, ids)]
    starts = [e - lengths[i] for e, lengths, i in zip(ends, s.lengths, ids)]
    a, b = (pd.DataFrame({"start": st, "doc": d, "at": np.arange(len(st))}) for st, d in zip(starts, docs))
    there = pd.merge_asof(a, b, on="start", by="doc", suffixes=("_a", "_b"))
    back = pd.merge_asof(b, a, on="start", by="doc", suffixes=("_b", "_a"))
    # Tokens that start together are found from both sides.
    once = ~np.isin(starts[1], starts[0], assume_unique=True)
    at_a = np.concatenate([there["at_a"].to_numpy(), back["at_a"].to_numpy()[once]])
    at_b = np.concatenate([there["at_b"].to_numpy(), back["at_b"].to_numpy()[once]])

    links = np.bincount(docs[0][at_a], minlength=len(texts)) if len(at_a) else np.zeros(len(texts), np.int64)
    last = [np.isin(ends[k], ends[1 - k], assume_unique=True) for k in (0, 1)]
    groups = np.bincount(docs[0][last[0]], minlength=len(texts)) if len(ids[0]) else np.zeros(len(texts), np.int64)
    digests = group_digests(ids, sizes, last, s)

    pair = ids[0][at_a] << 32 | ids[1][at_b]
    order = np.lexsort((pair, docs[0][at_a]))
    pair, doc = pair[order], docs[0][at_a][order]
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(pair)))
    offsets = np.searchsorted(doc[at], np.arange(len(texts) + 1))
    return sizes[0], sizes[1], groups, links, digests, offsets, pair[at], times


def group_digests(ids: list, sizes: list, last: list, s: Sides) -> list[str]:
    """SHA-256 of "a1,a2|b1;a3|b2,b3": in each group the ids of the first side, then those of the second."""
    group = [np.cumsum(x) - x for x in last]  # ends of groups so far; a token that ends one belongs to it
    key = np.concatenate([group[0] * 2, group[1] * 2 + 1])
    offset = len(s.bytes[0])
    name = np.concatenate([ids[0] * 2 + last[0], (ids[1] + offset) * 2 + last[1]])
    fragments = s.names[name[np.argsort(key, kind="stable")]]
    digests, start = [], 0
    for n in (sizes[0] + sizes[1]).tolist():
        joined = "".join(fragments[start : start + n].tolist())[:-1]
        digests.append(hashlib.sha256(joined.encode()).hexdigest() if n else "")
        start += n
    return digests


def aligned(df: DataFrame, first: str, second: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: token, group and link numbers, digest of the groups, distinct linked pairs of ids and their times."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sides(first, second)
        for batch in pieces(batches, BATCH_CHARS):
            n_a, n_b, groups, links, digests, offsets, pairs, times = align(batch.column(2).to_pylist(), s)
            places = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    *(pa.array(x, pa.int64()) for x in (n_a, n_b, groups, links)),
                    pa.array(digests, pa.string()),
                    *(pa.ListArray.from_arrays(places, pa.array(x, pa.int64())) for x in (pairs, times)),
                ],
                ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
            )

    numbered = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    return numbered.mapInArrow(rows, ALIGNED)


def pair_counts(held: DataFrame) -> DataFrame:
    """pair, its number of documents, whether it is its first id's most frequent pair."""
    counts = held.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    # At most one row per id of the second side in a window.
    same = W.partitionBy(F.shiftright("pair", 32))
    return counts.withColumn("best", F.col("n") == F.max("n").over(same))


def least_frequent(counts: DataFrame, most: int) -> int:
    """The least count such that at most ``most`` pairs have it or a greater one, to the accuracy of a level."""
    level = F.floor(F.log2(F.col("n").cast("double")) * LEVELS)
    # One row per level reaches the driver: some hundreds, whatever the corpus.
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("pairs"), F.min("n").alias("least"))
    taken, least = 0, (1 << 62)
    for row in levels.orderBy(F.desc("level")).collect():
        if (taken := taken + row["pairs"]) > most:
            break
        least = row["least"]
    return least


def with_pair_counts(held: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """n_best (links whose pair is its first id's most frequent) and count_sum (counts over links) added to ``aligned`` rows.

    ``held`` is read several times: hand over a stored table.
    """
    counts = stored(pair_counts(held), "pair-counts")
    least = least_frequent(counts, frequent)
    often, seldom = counts.where(F.col("n") >= least), counts.where(F.col("n") < least)
    linked = held.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    sums = (
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("times")).alias("count_sum"),
    )
    # At most ``frequent`` rows, counted above.
    known = linked.join(F.broadcast(often), "pair").groupBy("row").agg(*sums)
    others = linked.join(F.broadcast(often.select("pair")), "pair", "left_anti").join(seldom, "pair").groupBy("row").agg(*sums)
    both = known.unionByName(others).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return held.drop("pairs", "times").join(both, "row", "left").withColumns({"n_best": zero("n_best"), "count_sum": zero("count_sum")})


def decide(df: DataFrame, first: str, second: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: numbers of tokens, groups and links, links by corpus-wide counts, digest of the groups."""
    held = stored(aligned(df, first, second, id, text), "aligned")
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return with_pair_counts(held).select(*columns)
