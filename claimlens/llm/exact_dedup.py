"""Exact dedup with a heavy-hitter split.

A Misra-Gries pass (``freqItems``) names the digests that may be frequent. One counting pass over
just these verifies them and finds the row that stays; at most ``1 / support`` of them exist, so they
are broadcast and their copies go where they are read. All other digests take an ordinary shuffle;
none of them can hold more than ``support`` of the rows.

Defined results: a null text is an empty one and equal to it. Of equal texts the row with the largest
id stays, a null id being the smallest of all. ``decide`` marks rows with equal text and equal id alike
(all kept or all dropped); ``dedup`` lets exactly one row of each text through. An empty table gives
no rows. Columns besides id and text are carried along untouched by ``dedup``; helper columns have
names of their own (``__dedup_*``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlens.llm.base import stored, text_of

DIGEST, KEEP, SIZE, RANK = "__dedup_digest", "__dedup_keep", "__dedup_size", "__dedup_rank"

# A digest may be treated as frequent from this share of all rows on: at most 1,000 of them exist.
SUPPORT = 0.001


def heavy_groups(digests: DataFrame, id: str, support: float = SUPPORT) -> DataFrame:
    """Digest, largest id and count of the frequent digests with copies: at most ``1 / support`` rows."""
    found = digests.freqItems([DIGEST], support)
    named = found.select(F.explode(found.columns[0]).alias(DIGEST)).where(F.col(DIGEST).isNotNull())
    return (
        digests.join(F.broadcast(named), DIGEST, "left_semi")
        .groupBy(DIGEST)
        .agg(F.max(id).alias(KEEP), F.count("*").alias(SIZE))
        .where(F.col(SIZE) > 1)
    )


def decide(df: DataFrame, id: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per row: id, keep_id, group_size, kept, text_sha256."""
    digests = stored(df.select(F.col(id), F.sha2(text_of(text), 256).alias(DIGEST)), "digests")
    heavy = stored(heavy_groups(digests, id, support), "heavy-digests")
    split = digests.join(F.broadcast(heavy), DIGEST, "left")
    same = W.partitionBy(DIGEST)
    light = (
        split.where(F.col(SIZE).isNull())
        .withColumn(KEEP, F.max(id).over(same))
        .withColumn(SIZE, F.count("*").over(same))
    )
    return (
        split.where(F.col(SIZE).isNotNull())
        .unionByName(light)
        .select(
            F.col(id),
            F.col(KEEP).alias("keep_id"),
            F.col(SIZE).alias("group_size"),
            F.col(id).eqNullSafe(F.col(KEEP)).alias("kept"),
            F.col(DIGEST).alias("text_sha256"),
        )
    )


def dedup(df: DataFrame, id: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """The rows that stay, with all their columns.

    Copies of a frequent text go map-side. What is left is ranked within its digest; Spark drops all
    but the best row of a digest in each task before the shuffle too.
    """
    keyed = df.withColumn(DIGEST, F.sha2(text_of(text), 256))
    heavy = stored(heavy_groups(keyed.select(F.col(id), DIGEST), id, support), "heavy-digests")
    left = keyed.join(F.broadcast(heavy), DIGEST, "left").where(
        F.col(SIZE).isNull() | F.col(id).eqNullSafe(F.col(KEEP))
    )
    first = W.partitionBy(DIGEST).orderBy(F.col(id).desc_nulls_last())
    return left.withColumn(RANK, F.row_number().over(first)).where(F.col(RANK) == 1).select(*[df[c] for c in df.columns])
