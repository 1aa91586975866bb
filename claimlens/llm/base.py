"""What the operators share: tables, stored intermediate results, words, Arrow batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import claimlens
from claimlens.session import configure, run_folder

# A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

# Rows and bytes of a batch handed to Python: bounds a worker's memory where texts are long.
BATCH_ROWS, BATCH_BYTES = "1000", "4m"


def ready(spark: SparkSession) -> SparkSession:
    """The library's runtime settings, small Arrow batches, and this package on the Python workers' path."""
    configure(spark)
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per context, so that it need not be installed there."""
    context = spark.sparkContext
    if getattr(context, "claimlens_shipped", False):
        return
    package = Path(claimlens.__file__).parent
    path = Path(tempfile.mkdtemp(prefix="claimlens-")) / "claimlens.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(path))
    context.claimlens_shipped = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the folder that all executors share and read back: cuts the lineage."""
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str) -> Column:
    """The column as text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def texts_of(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """Python strings of an Arrow column, null as empty."""
    return [x or "" for x in column.to_pylist()]


def pieces(batches: Iterator[pa.RecordBatch], chars: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about so many bytes, one row at least."""
    for batch in batches:
        rows = batch.num_rows
        step = max(1, min(rows, int(rows * chars / max(1, batch.nbytes))))
        for i in range(0, rows, step):
            yield batch.slice(i, step)
