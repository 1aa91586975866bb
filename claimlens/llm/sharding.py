"""Contiguous shards of near-equal bytes by global prefix sums.

Rows are sorted by text digest and id over the whole cluster; every sorted partition reports its
bytes and rows, and a prefix sum over these few totals places each partition in the global order.
Inside a partition the running sum is local. The byte axis is cut at equal targets.

Defined results: a row weighs the UTF-8 bytes of its text (null: none) plus 8. Rows with equal text
are one group and stay together: a group goes where its middle byte falls. Only a group that is
larger than a whole shard's target is cut, row by row, by the middle byte of each row; sizes then
stay near equal all the same. A shard's size differs from the target by at most the largest group
below that limit. Shards are numbered along the order, slots count from 0 in each shard without
gaps, and a table with fewer groups than shards leaves shards empty. Repeated rows each get their own
slot; an empty table gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlens.llm.base import stored, text_of

# Added to each text's bytes, so that empty texts weigh something too.
ROW_BYTES = 8


def shard_by_bytes(df: DataFrame, shards: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, size, text_crc32, law ("bytes"), shard, slot and grown_shard (null) of each row."""
    content = text_of(text)
    narrow = df.select(
        F.col(id),
        (F.octet_length(content) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.unhex(F.sha2(content, 256)).alias("digest"),
    )
    # The limits of a distributed sort are sampled; all later steps must see the same ones.
    rows = stored(narrow.orderBy("digest", id).withColumn("place", F.monotonically_increasing_id()), "sorted")
    rows = rows.withColumn("part", F.shiftright("place", 33))

    totals = rows.groupBy("part").agg(F.sum("size").alias("part_bytes"), F.count("*").alias("part_rows"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy("part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("part_bytes").over(everything).alias("total"),
    )
    inside = W.partitionBy("part").orderBy("place")
    placed = (
        rows.withColumn("own_bytes", F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("own_row", F.row_number().over(inside))
        # One row per sorted partition.
        .join(F.broadcast(offsets), "part")
        .withColumn("start", F.col("bytes_before") + F.col("own_bytes") - F.col("size"))
        .withColumn("row", F.col("rows_before") + F.col("own_row") - 1)
        .drop("place", "part", "own_bytes", "own_row", "bytes_before", "rows_before")
    )
    groups = (
        placed.groupBy("digest")
        .agg(F.min("start").alias("group_start"), F.sum("size").alias("group_size"), F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
        .drop("copies")
    )
    whole = F.col("group_size") * shards <= F.col("total")
    start = F.when(whole, F.col("group_start")).otherwise(F.col("start"))
    size = F.when(whole, F.col("group_size")).otherwise(F.col("size"))
    middle = (start * 2 + size) * F.lit(shards)
    sharded = placed.join(groups, "digest", "left").withColumn(
        "shard", F.floor((middle - F.pmod(middle, F.col("total") * 2)) / (F.col("total") * 2)).cast("int")
    )
    sharded = stored(sharded.select(id, "size", "text_crc32", "row", "shard"), "shards")
    firsts = sharded.groupBy("shard").agg(F.min("row").alias("first_row"))
    # One row per shard.
    return sharded.join(F.broadcast(firsts), "shard").select(
        F.col(id),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row") - F.col("first_row")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
