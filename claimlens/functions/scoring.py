"""Score levels, actions, period tags and the score row."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens import config as C


def probability_of_one(vector: str = "probability") -> Column:
    return vector_to_array(F.col(vector)).getItem(1)


def risk_level(score: Column, limits: C.Thresholds = C.Thresholds()) -> Column:
    return (
        F.when(score >= limits.high, C.ALTO).when(score >= limits.medium, C.MEDIO).otherwise(C.BAJO)
    )


def risk_action(level: Column) -> Column:
    return (
        F.when(level == C.ALTO, C.ACTIONS[C.ALTO])
        .when(level == C.MEDIO, C.ACTIONS[C.MEDIO])
        .otherwise(C.ACTIONS[C.BAJO])
    )


def flagged(score: Column, cutoff: float = C.Thresholds().high) -> Column:
    return F.when(score >= cutoff, 1).otherwise(0)


def score_rows(
    scored: DataFrame,
    model_version: str | Column,
    run_id: str | Column,
    scored_at: datetime | Column,
    limits: C.Thresholds = C.Thresholds(),
    mode: str = "batch",
) -> DataFrame:
    """The nine published columns from a frame with the key and ``score_fraude``."""

    def const(value):
        return value if isinstance(value, Column) else F.lit(value)

    score = F.col("score_fraude").cast("double")
    level = risk_level(score, limits)
    return scored.select(
        F.col(C.KEY).cast("string").alias(C.KEY),
        score.alias("score_fraude"),
        level.alias("nivel_riesgo"),
        risk_action(level).alias("accion_sugerida"),
        const(scored_at).cast("timestamp").alias("fecha_scoring"),
        const(model_version).alias("version_modelo"),
        const(run_id).alias("id_ejecucion"),
        F.lit(mode).alias("modo_scoring"),
        F.lit("SUCCESS").alias("estado_scoring"),
    )


def missing(name: str) -> Column:
    """Null or NaN, for a floating column."""
    return F.col(name).isNull() | F.isnan(name)


def version_number(version: Column) -> Column:
    """The digits after the last colon; a text without them is its own version."""
    digits = F.regexp_extract(version, r":([0-9]+)$", 1)
    return F.coalesce(F.nullif(digits, F.lit("")), version)


def short_hash_key(key: Column, prefix: str) -> Column:
    """Prefix and the first 24 hexadecimal digits of SHA-256."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(key, 256), 1, 24))


def row_hash(columns: list[str], salt: str = "") -> Column:
    """A 64-bit digest of several columns; the place of a null counts, as its flag goes in too."""
    parts = [F.lit(salt)]
    for c in columns:
        parts += [F.isnull(c), F.col(c)]
    return F.xxhash64(*parts)
