"""Table changes as DataFrame functions that return rows to add or the new table content.

A null key never matches. Joins are equi joins on the key, so the optimizer broadcasts a small
source by its measured size and splits skewed partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_rows(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key is not in the target. Only the key columns of the target are read."""
    return source.join(target.select(*keys), keys, "left_anti").select(*source.columns)


def merge_insert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Insert-only merge: existing keys stay as they are. Doing it twice changes nothing."""
    return target.unionByName(new_rows(source, target, keys).select(*target.columns))


def check_unique(source: DataFrame, keys: list[str]) -> None:
    """An updating merge needs at most one source row per key."""
    if not duplicate_keys(source.dropna(subset=keys), keys).isEmpty():
        raise ValueError(f"merge source has several rows for one key {keys}")


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str], check: bool = True) -> DataFrame:
    """Merge that replaces matched rows and inserts the others."""
    if check:
        check_unique(source, keys)
    kept = target.join(source.select(*keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(source.select(*target.columns))


def merge_update(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], check: bool = True) -> DataFrame:
    """Merge that updates only ``columns`` of matched rows and inserts the others whole.

    A matched row takes the source values, nulls included; its other columns stay.
    """
    if check:
        check_unique(source, keys)
    incoming = source.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    updated = target.join(incoming, keys, "left").select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in target.columns
        ]
    )
    return updated.unionByName(new_rows(source, target, keys).select(*target.columns))


def delete_run(target: DataFrame, run_id: str, column: str = "id_ejecucion") -> DataFrame:
    """The table without the rows of a run; rows of no run stay."""
    return target.filter(~F.col(column).eqNullSafe(run_id))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row, counted map-side first."""
    return df.groupBy(*keys).agg(F.count("*").alias("veces")).filter("veces > 1")
