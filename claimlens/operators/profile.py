"""Column profiles and key checks, each in one pass over the data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens import config as C


def _long(df: DataFrame, names: list[str], measures: list[str], label: str) -> DataFrame:
    """One row of ``<name>__<measure>`` columns turned into one row per name."""
    cells = ", ".join(f"'{n}', " + ", ".join(f"`{n}__{m}`" for m in measures) for n in names)
    return df.select(F.expr(f"stack({len(names)}, {cells}) as ({', '.join([label, *measures])})"))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column (columna, nulos)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}__nulos") for c in df.columns])
    return _long(counts, df.columns, ["nulos"], "columna")


def column_profile(df: DataFrame) -> DataFrame:
    """Nulls and approximate distinct values of every column, one scan for all columns."""
    row = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}__nulos") for c in df.columns],
        *[F.approx_count_distinct(c).alias(f"{c}__cardinalidad_aprox") for c in df.columns],
    )
    return _long(row, df.columns, ["nulos", "cardinalidad_aprox"], "columna").orderBy(
        F.desc("nulos"), F.desc("cardinalidad_aprox"), "columna"
    )


def _is_missing(df: DataFrame, name: str) -> Column:
    test = F.col(name).isNull()
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        test = test | F.isnan(name)
    return test


def missing_profile(df: DataFrame, names: list[str] = C.FEATURES) -> DataFrame:
    """Null or NaN values per feature, and their share of the batch, most missing first."""
    row = df.agg(
        *[F.count_if(_is_missing(df, n)).alias(f"{n}__valores_faltantes") for n in names],
        *[F.avg(_is_missing(df, n).cast("double")).alias(f"{n}__porcentaje_faltante") for n in names],
    )
    return _long(row, names, ["valores_faltantes", "porcentaje_faltante"], "variable").orderBy(
        F.desc("porcentaje_faltante"), "variable"
    )


def blank_keys(df: DataFrame, key: str = C.KEY) -> DataFrame:
    """Rows without a usable key."""
    return df.filter(F.col(key).isNull() | (F.trim(F.col(key).cast("string")) == ""))


@dataclass(frozen=True)
class KeyFacts:
    rows: int
    blank: int
    duplicated: int

    def require_clean(self) -> None:
        if self.blank:
            raise ValueError(f"{self.blank} claims without {C.KEY}")
        if self.duplicated:
            raise ValueError(f"{self.duplicated} values of {C.KEY} occur more than once")


def key_facts(df: DataFrame, key: str = C.KEY) -> KeyFacts:
    """Rows, blank keys and repeated keys of a batch, all from one aggregation of the keys."""
    is_blank = F.col(key).isNull() | (F.trim(F.col(key).cast("string")) == "")
    row = (
        df.groupBy(key)
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(is_blank, F.col("n"))), F.lit(0)).alias("blank"),
            F.count_if((F.col("n") > 1) & ~is_blank).alias("duplicated"),
        )
        .first()
    )
    return KeyFacts(row["rows"], row["blank"], row["duplicated"])


def verify_batch(df: DataFrame, expected: int | None = None, key: str = C.KEY) -> KeyFacts:
    """A written batch must have no blank or repeated key and, if a number is given, exactly so many rows."""
    facts = key_facts(df, key)
    if expected is not None and facts.rows != expected:
        raise ValueError(f"batch has {facts.rows} rows, expected {expected}")
    facts.require_clean()
    return facts
