"""Claims that arrive as files, scored by the batch flow in micro-batches.

Not part of the scoring contract itself: arrival in batches or events ends in the same batch
function. The run id follows from the batch number, so a batch that is replayed after a failure
finds its own rows and publishes only what is missing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from claimlens import config as C
from claimlens.plans.batch_scoring import ScoringTables, score_batch


def score_arrivals(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    scorer: Callable[[DataFrame], DataFrame],
    model_version: str,
    checkpoint: str,
    tables: ScoringTables = ScoringTables(),
    limits: C.Thresholds = C.Thresholds(),
    files_per_batch: int = 1000,
    run_prefix: str = "stream",
) -> StreamingQuery:
    """Score all files below ``path`` that no earlier call has seen, then stop.

    Each micro-batch is one run with its own audit row. ``checkpoint`` must be a shared folder.
    """
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)

    def run(batch: DataFrame, number: int) -> None:
        score_batch(batch, scorer, model_version, tables, limits, run_id=f"{run_prefix}-{number}", mode="stream")

    return (
        arriving.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
