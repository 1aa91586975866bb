"""Reading and writing tables.

Parquet tables cannot be changed in place, so every change is one of three writes: append of
rows known to be new, overwrite of whole partitions (a run owns its partition), or a new
snapshot of the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def scan(spark: SparkSession, name: str, folder: str | None = None) -> DataFrame:
    """A catalog table by its (one- to three-part) name, or the parquet table in ``folder``."""
    if folder is None:
        return spark.table(name)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def table_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """The table if it exists, else no rows of its schema (the first run has no output table)."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a schema unless it exists; its tables go below ``location`` if given."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{where}")


@contextmanager
def passing_schema(spark: SparkSession) -> Iterator[str]:
    """A schema of its own that is dropped with all its tables and views at the end."""
    name = f"claimlens_{uuid.uuid4().hex}"
    create_schema(spark, name)
    try:
        yield name
    finally:
        spark.sql(f"DROP SCHEMA {name} CASCADE")


def _create(df: DataFrame, name: str, partition_by: list[str] | None, location: str | None) -> None:
    """First write of a table, in the warehouse or below a given folder."""
    writer = df.write.format("parquet").mode("append")
    if location:
        writer = writer.option("path", f"{location.rstrip('/')}/{name.split('.')[-1]}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def append(df: DataFrame, name: str, partition_by: list[str] | None = None, location: str | None = None) -> None:
    """Append in the column order of the target; creates the table on first use.

    No count is taken first: an append without rows adds no data.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        df.select(*spark.table(name).columns).write.insertInto(name)
        return
    _create(df, name, partition_by, location)


def overwrite(df: DataFrame, name: str) -> None:
    """Replace the rows and the schema of a table."""
    df.write.format("parquet").mode("overwrite").option("partitionOverwriteMode", "static").saveAsTable(name)


def replace_partitions(df: DataFrame, name: str, partition_by: list[str], location: str | None = None) -> None:
    """Replace exactly those partitions that ``df`` has rows for; others are not read or written."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        _create(df, name, partition_by, location)
        return
    (
        df.select(*spark.table(name).columns)
        .write.option("partitionOverwriteMode", "dynamic")
        .insertInto(name, overwrite=True)
    )


def drop_partition(spark: SparkSession, name: str, column: str, value: str) -> None:
    """Remove one partition of a table and verify that none of its rows is left.

    The empty overwrite removes the data files of tables with a folder of their own, too, which
    dropping the partition alone would leave behind.
    """
    quoted = value.replace("\\", "\\\\").replace("'", "\\'")
    others = T.StructType([f for f in spark.table(name).schema.fields if f.name != column])
    nothing = spark.createDataFrame([], others)
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({column} = '{quoted}') SELECT * FROM {{nothing}}", nothing=nothing)
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({column} = '{quoted}')")
    if not spark.table(name).filter(F.col(column) == value).isEmpty():
        raise ValueError(f"partition {column}={value} of {name} still has rows")


def stage_run(df: DataFrame, path: str, run_id: str, run_column: str = "id_ejecucion") -> DataFrame:
    """Write a run into its own partition below ``path`` and read back only that partition.

    A repeated run replaces its earlier rows; other runs stay. The columns come back in the
    order of ``df``.
    """
    spark = df.sparkSession
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(run_column)
        .parquet(path)
    )
    return spark.read.schema(df.schema).parquet(path).filter(F.col(run_column) == run_id).select(*df.columns)


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    """Materialise a result as a parquet table and continue from it with a short plan."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish_view(spark: SparkSession, name: str, df: DataFrame, sql: str | None = None) -> None:
    """A persisted view when given SQL over catalog tables, else a session view of ``df``."""
    if sql is not None:
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")
    else:
        df.createOrReplaceTempView(name)
