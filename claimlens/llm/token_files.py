"""Token ids on disk, packed with Simple-8b.

A corpus is a Parquet table of blocks, so that tasks commit their output atomically and any store will do. A
block holds the ids of whole documents, some ``BLOCK_IDS`` of them, as one run of Simple-8b words:

  part, block    the sorted partition and the block's number in it: ascending order of documents
  before, n_ids  ids in the earlier blocks of the part, ids in this block
  doc_ids        ids of its documents (null: a row without id)
  ends           where each document ends in the block, end id included
  words          the packed ids, little-endian 64-bit words

``ends`` are the offsets into the block: any document can be cut out after one vectorised decode of
its block, and blocks are read independently. A document longer than ``BLOCK_IDS`` makes a block of its own.

Defined results: documents are written in ascending order of their id, null first; rows with equal ids
follow each other in the order in which the sort leaves them, each with its own end id. A null text is
empty: its only id is the end id. An empty table makes a corpus without blocks. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlens.llm import simple8b
from claimlens.llm.base import pieces, text_of, texts_of
from claimlens.llm.tokenizer import encoder

BLOCK_IDS = 1 << 16
BLOCKS = "part int, block long, before long, n_ids long, doc_ids array<long>, ends array<long>, words binary"


def write_tokens(
    df: DataFrame, path: str, tokenizer: str, end_id: int, id: str = "doc_id", text: str = "text"
) -> None:
    """Encode every row, append the end id, and write the blocks to ``path``."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, end, number = encoder(tokenizer), np.array([end_id], np.uint32), 0
        runs, docs, ends, part, before = [], [], [], 0, 0

        def block() -> pa.RecordBatch:
            words = simple8b.encode(np.concatenate(runs)).astype("<u8")
            values = [[part], [number], [before], [ends[-1]], [docs], [ends], [words.tobytes()]]
            kinds = [pa.int32(), *[pa.int64()] * 3, pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds)],
                ["part", "block", "before", "n_ids", "doc_ids", "ends", "words"],
            )

        for batch in pieces(batches):
            for part, doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2))):
                ids = e.encode(value)
                runs += [ids, end]
                docs.append(doc)
                ends.append((ends[-1] if ends else 0) + len(ids) + 1)
                if ends[-1] >= BLOCK_IDS:
                    yield block()
                    before += ends[-1]
                    runs, docs, ends, number = [], [], [], number + 1
        if ends:
            yield block()

    rows = df.select(F.col(id).cast("long").alias("id"), text_of(text).alias("text")).orderBy("id")
    numbered = rows.select(F.spark_partition_id().alias("part"), "id", "text")
    numbered.mapInArrow(blocks, BLOCKS).write.option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids (little-endian 32-bit)."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = simple8b.decode(np.frombuffer(row["words"], "<u8"), row["n_ids"]).astype("<u4")
                ends = row["ends"]
                starts = [0, *ends[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array([row["start"] + s for s in starts], pa.int64()),
                        pa.array([b - a for a, b in zip(starts, ends)], pa.int64()),
                        pa.array([ids[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return placed(spark, path).mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")


def placed(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``start``, the number of ids before each in the whole corpus."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("part_ids").over(earlier), F.lit(0)).alias("part_before"))
    # One row per sorted partition; the blocks stay where they are read.
    return blocks.join(F.broadcast(offsets), "part").withColumn("start", F.col("part_before") + F.col("before"))
